"""Operators for preparing training data; their queries are in `queries.py`. Nothing else in the library imports this package."""
