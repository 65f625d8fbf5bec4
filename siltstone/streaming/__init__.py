"""Structured Streaming forms of the forward window."""
