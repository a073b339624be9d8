"""Operators that prepare training text: deduplication, quality, mixing, packing, formatting, scoring, output."""
