"""Operators: DataFrames in, a DataFrame out; no actions, no session changes."""
