"""Operators for large-scale training-data preparation. Nothing outside this package imports it."""
