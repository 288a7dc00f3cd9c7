"""Operators for preparing training text: cleaning, deduplication, scoring, encoding, archives."""
