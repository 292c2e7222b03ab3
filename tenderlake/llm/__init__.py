"""Operators for preparing language-model training data, and their queries.

Nothing else in the library imports this subpackage; ``queries.py`` registers
one query per operator.
"""
