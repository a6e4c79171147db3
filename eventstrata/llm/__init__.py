"""Operators for large text corpora, their queries and the expected SQL."""
