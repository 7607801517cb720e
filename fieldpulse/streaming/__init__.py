"""Structured Streaming versions of the operators."""
