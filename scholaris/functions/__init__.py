"""Scalar functions and aggregates as Column expressions; none of them is a UDF."""
