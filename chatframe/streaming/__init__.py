"""Structured Streaming variants of the stateless and sessionising operators."""
