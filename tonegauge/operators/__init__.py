"""Relational operators, DataFrame in and DataFrame out."""
