"""Institutional analytics on Spark: staging, quality checks, a star schema,
governed views and the reports on top of them, all as DataFrame operators."""
