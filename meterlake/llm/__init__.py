"""Operators for training-data pipelines over a table of documents; nothing outside this package imports it."""
