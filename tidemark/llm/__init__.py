"""Operators that prepare text for training language models.

Nothing else in the library imports this subpackage. Each operator takes DataFrames and returns
DataFrames; the registered queries live in ``queries``.
"""
