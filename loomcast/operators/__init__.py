"""Operators: each takes a series table and returns a DataFrame."""
