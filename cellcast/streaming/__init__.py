"""Incremental reductions with Structured Streaming."""
