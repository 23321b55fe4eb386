"""Operators of a training-data pipeline: packing, tokens, quality, duplicates, search, models."""
