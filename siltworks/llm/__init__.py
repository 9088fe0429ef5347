"""Operators for training data: one module per problem, their queries in ``queries.py``. Nothing outside this package imports it."""
