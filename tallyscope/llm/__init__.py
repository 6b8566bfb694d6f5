"""Operators that prepare training data: dedup, tokens, shards, packing, quality, language."""
