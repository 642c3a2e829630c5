"""Operators of the training-data pipeline over documents, conversations and benchmark items."""
