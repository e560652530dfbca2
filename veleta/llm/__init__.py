"""Operators for building training corpora: cleaning, deduplication, tokens, shards."""
