"""Incremental loads as Structured Streaming queries (SM1-SM5)."""
