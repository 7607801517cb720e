"""Composed plans: dashboard queries, the batch flow and the query catalogue."""
