"""Operators for training-data pipelines: search, deduplication, scoring, packing, decontamination."""
