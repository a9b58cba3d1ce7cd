"""Operators for preparing training data: language, tokens, duplicates, packing, search, privacy."""
