"""Operators for preparing training text: mixing, counting, deduplication, filters and sharding."""
