"""Structured Streaming twins of the collection steps."""
