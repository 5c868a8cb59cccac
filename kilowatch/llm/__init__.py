"""Operators that prepare training data: filters, near-duplicates, sharding, mixing, token files."""
