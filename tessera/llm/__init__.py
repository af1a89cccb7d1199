"""Operators of a training-data pipeline: scoring, tokenizing, filtering,
de-duplicating and sharding text. Nothing else in the library imports them."""
