"""Operators on text corpora for training data: filters, duplicates, scoring, tokens, packing."""
