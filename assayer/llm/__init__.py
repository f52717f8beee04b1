"""Operators for training-data corpora: sharding, packing, filtering, archives, near-duplicates, mixing."""
