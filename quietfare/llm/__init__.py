"""Operators for text and language-model data. Nothing else in the library imports this package."""
