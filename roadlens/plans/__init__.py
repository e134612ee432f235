"""Whole pipelines: cleaning, star schema, models, marts, questions, checks."""
