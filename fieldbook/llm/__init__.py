"""Operators for preparing text corpora: filters, duplicates, tokens and extraction."""
