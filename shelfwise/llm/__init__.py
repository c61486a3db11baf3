"""Operators for large-scale training-data preparation over ``documents``."""
