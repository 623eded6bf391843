"""Operators for training-data pipelines: scoring, deduplication, filtering, encoding and packing.

Nothing outside this subpackage imports it.  Every operator takes a DataFrame and column
names, reads only the columns it is given, and returns a DataFrame; the thin ``opN_`` queries
in :mod:`talkloom.llm.queries` apply them to the driver tables.
"""
