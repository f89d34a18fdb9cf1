"""Operators: each takes DataFrames plus plain configuration and returns DataFrames."""
