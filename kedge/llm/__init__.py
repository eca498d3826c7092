"""Operators for training data: canonical text, near duplicates, matching, tokens, mixing, garbled text."""
