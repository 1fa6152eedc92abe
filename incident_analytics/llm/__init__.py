"""Operators for large text corpora, each with a registered query."""
