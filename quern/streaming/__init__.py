"""Streaming forms of the stateless rules."""
