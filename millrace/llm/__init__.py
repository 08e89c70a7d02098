"""Operators for training-data pipelines: cleaning, deduplication, filtering and mixing of documents."""
