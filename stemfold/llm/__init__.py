"""Operators for building training data from text, page and vector tables.

Nothing else in the library imports this subpackage.
"""
