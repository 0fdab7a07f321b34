"""Operators for training-data corpora: cleaning, deduplication, decontamination, formatting, packing."""
