"""Structured Streaming forms of the load and of scoring."""
