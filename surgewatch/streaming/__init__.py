"""Structured Streaming versions of the batch plan."""
