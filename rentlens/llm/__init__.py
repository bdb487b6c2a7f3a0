"""Operators of a training-data pipeline: deduplication, mixing, tokenising, language, URL and licence filters."""
