"""Operators for large-scale training-data pipelines (text, web pages, tokens)."""
