"""Training-data pipeline operators: scoring, filtering, deduplication, tokenisation.

Nothing else in the library imports this subpackage.
"""
