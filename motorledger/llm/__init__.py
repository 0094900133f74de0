"""Operators for training-data pipelines over whole text collections."""
