"""Operators for training-data pipelines: sharding, deduplication, filtering, mixing, scoring.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` applies them to the
driver's tables.
"""
