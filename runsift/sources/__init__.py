"""Readers and stored tables."""
