"""Structured Streaming operators and the sinks that run them to the end of the available data."""
