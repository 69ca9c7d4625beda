"""Operators for preparing training text: deduplication, tokens, packing, sharding, filters."""
