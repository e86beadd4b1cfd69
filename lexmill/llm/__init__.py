"""Operators for training data: one module each, their checked queries in queries.py."""
