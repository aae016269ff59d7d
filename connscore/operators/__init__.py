"""Operators: each takes DataFrames and column roles, returns a DataFrame."""
