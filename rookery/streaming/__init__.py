"""Structured Streaming versions of the change-log operators."""
