"""Operators for large text corpora: quality, duplicates, formatting, mixing, tokens, licences and URL rules."""
