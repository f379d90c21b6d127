"""Operators for preparing training text: filtering, deduplication, mixing, formatting and packing."""
