"""Operators for training-data preparation: dedup, filters, tokens, archives, scoring.

Nothing else in the library imports this subpackage.
"""
