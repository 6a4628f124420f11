"""Operators for training-data corpora: tokenising, filtering, deduplication, extraction and archives."""
