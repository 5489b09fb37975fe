"""Operators for preparing training data: deduplication, mixing, decontamination, tokens, shards."""
