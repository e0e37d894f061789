"""Incremental versions of the flows on Structured Streaming."""
