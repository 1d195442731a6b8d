"""Operators for large text corpora: cleaning, deduplication, token counting, packing, sharding, archives."""
