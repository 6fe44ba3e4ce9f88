"""Operators for training-data pipelines: deduplication, classifiers, tokenisation, scoring.

Each module holds one operator with its own general interface; ``keys`` registers the queries.
Nothing outside this subpackage imports it.
"""
