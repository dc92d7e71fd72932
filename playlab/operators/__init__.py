"""Operators: each takes and returns DataFrames (or fitted Spark ML models)."""
