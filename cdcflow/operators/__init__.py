"""DataFrame-to-DataFrame operators: state, history, flattening, writes, latency trace and its reports."""
