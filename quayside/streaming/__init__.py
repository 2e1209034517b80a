"""Structured Streaming wrappers around the pure operators."""
