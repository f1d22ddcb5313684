"""Complete queries: the wide account view, and the registered queries over the test tables."""
