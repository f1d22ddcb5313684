"""Where changes, records and lookups come from, and how tables are written."""
