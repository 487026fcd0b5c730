"""Operators for preparing language-model training data, one module per operator.

Nothing else in the library imports this subpackage. ``queries.py`` registers one query per operator.
"""
