"""Operators for training-data corpora: mixing, near-duplicates, extraction, privacy, packing, licences, quality, archives."""
