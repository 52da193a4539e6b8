"""Operators for large-scale training-data preparation (text corpora).

Thirteen operators, one module each, and the queries that apply them to whole
tables (``catalog.py``).  Nothing else in the library imports this package.
"""
