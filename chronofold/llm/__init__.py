"""Operators for preparing training data: scoring, deduplication, cleaning, mixing, packing."""
