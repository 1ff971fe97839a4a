"""Operators: DataFrames in, a DataFrame out."""
