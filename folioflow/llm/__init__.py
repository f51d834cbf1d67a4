"""Operators for large-scale training-data preparation.

Self-contained: nothing outside this subpackage imports it.
"""
