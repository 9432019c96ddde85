"""Operators take and return DataFrames."""
