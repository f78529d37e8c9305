"""Operators for large text corpora. Optional: nothing outside imports this package."""
