"""Operators for large text corpora: duplicates, filters, scores, packing.

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; ``queries`` holds the thin registered
queries and ``oracles`` their SQL.
"""
