"""Expressions and numeric helpers shared by the operators."""
