"""Operators for training-data pipelines: deduplication, search, tokenizing, classifying, packing."""
