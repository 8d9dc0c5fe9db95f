"""Operators: pure functions from DataFrames to DataFrames, grouped by stage."""
