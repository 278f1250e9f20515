"""Operators for large text corpora: deduplication, filtering, language models, tokens and packing."""
