"""Operators of a training-data pipeline: deduplication, extraction, tokens, secrets and languages.

Nothing else in the library imports this subpackage.
"""
