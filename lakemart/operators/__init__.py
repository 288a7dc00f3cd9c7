"""Aggregates, joins, set operations and data-quality checks."""
