"""Operators of a training-data pipeline, each a function from DataFrames to DataFrames.

``queries.QUERIES`` registers one query per operator, ``queries.ORACLE`` the
DuckDB twins of those that SQL can express.  Nothing else in the library
imports this subpackage.
"""
