"""Joins, monthly sums and ranking, each a function from DataFrames to a DataFrame."""
