"""Operators of a large-scale training-data pipeline (text, links, vectors)."""
