"""Reusable relational building blocks; each maps DataFrames to a DataFrame."""
