"""Reusable DataFrame operators. Each takes DataFrames and column names, and is lazy."""
