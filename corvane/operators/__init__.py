"""Operators over DataFrames. None of them collects rows; order is always an explicit column."""
