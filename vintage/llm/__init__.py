"""Operators for training-data pipelines over text, vectors and pages.

Nothing outside this package imports it. Every operator takes and returns
DataFrames, selects only the columns it needs (so extra columns, whatever
their names, are harmless) and states in its docstring what it does with
nulls, empty texts, repeated rows and empty tables.
"""
