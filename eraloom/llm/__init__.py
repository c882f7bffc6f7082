"""Corpus-preparation operators for training text; nothing else in the library imports this package."""
