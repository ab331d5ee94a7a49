"""Operators for training-data pipelines: filters, near-duplicates, mixing, token files and more."""
