"""Operators of a training-data pipeline: formatting, language, quality, duplicates, packing, mixing, personal data."""
