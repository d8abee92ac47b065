"""Operators of a training-data pipeline, each built by a named published method.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames and column names, reads only the columns it is told about, and
states in its docstring what nulls, empty texts, ties, repeated rows and empty
tables give.
"""
