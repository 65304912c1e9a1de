"""Operators for preparing large text corpora: deduplication, filters, search, packing, tokens."""
