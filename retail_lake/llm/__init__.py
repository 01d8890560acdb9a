"""Operators of a training-data pipeline: sharding, deduplication, filters, packing, archives, tokens."""
