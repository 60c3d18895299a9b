"""Structured Streaming change feed."""
