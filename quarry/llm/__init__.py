"""Operators for large training-text corpora.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and their SQL.  Every operator takes and returns
DataFrames, selects the columns it needs first (so extra or clashing columns
of the input never matter) and documents its results for nulls, empty texts,
repeated rows and empty tables.
"""
