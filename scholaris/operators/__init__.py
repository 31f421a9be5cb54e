"""Operators over staging and star tables: DataFrames in, DataFrames out."""
