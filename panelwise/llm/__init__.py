"""Operators for training-data pipelines over text: one module each, and the queries that apply them."""
