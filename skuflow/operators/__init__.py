"""Operators: each is a function of DataFrames returning a DataFrame."""
