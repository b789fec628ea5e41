"""Operators over DataFrames, one module per area."""
