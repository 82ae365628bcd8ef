"""Operators for training-data pipelines over text, embeddings and web pages."""
