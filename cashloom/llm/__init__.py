"""Operators of a training-data pipeline: packing, tokens, deduplication, quality, language, web pages."""
