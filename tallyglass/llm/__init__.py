"""Operators for large training-data pipelines: deduplication, extraction, filtering, packing, search."""
