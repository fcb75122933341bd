"""Operators of a training-data pipeline: sharding, mixing, tokens, quality, search, near copies."""
