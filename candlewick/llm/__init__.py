"""Operators for large-scale training data: text, pages and vectors."""
