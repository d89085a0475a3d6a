"""Operators for large text corpora: deduplication, classification, extraction, sharding and packing."""
