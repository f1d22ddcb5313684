"""Structured Streaming forms: feed, current state, flattening, history, arrival stamps, live tables."""
