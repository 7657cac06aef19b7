"""Operators for the preparation of large text corpora; nothing else in the library imports this package."""
