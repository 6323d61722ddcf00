"""Operators for preparing training data, and their queries over the test tables.

Nothing else in the package imports this one. Every operator module has its contract in its docstring:
what it returns, and what happens to nulls, empty and very long texts, ties, repeated rows, empty tables
and extra columns.
"""
