"""Operators for preparing training text: extraction, encoding, deduplication, scoring, packing."""
