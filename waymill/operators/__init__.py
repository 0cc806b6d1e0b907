"""Joins, windows, aggregates and iterative operators on DataFrames."""
