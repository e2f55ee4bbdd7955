"""Operators for building training data from a document corpus.

Every operator takes and returns DataFrames; nothing else in the library
imports this package.  ``queries.py`` registers one query per operator.
"""
