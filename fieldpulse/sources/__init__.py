"""Contracts, readers, sinks and reference tables."""
