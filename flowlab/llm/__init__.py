"""Operators for text corpora: cleaning, linking, scoring and encoding of training data.

Nothing else in the library imports this subpackage. ``queries`` registers one query per operator.
"""
