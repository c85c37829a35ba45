"""Operators for training-data pipelines over the documents, labels, pages and benchmark tables."""
