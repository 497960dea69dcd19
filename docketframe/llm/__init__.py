"""Operators of training-data pipelines; nothing outside imports this package."""
