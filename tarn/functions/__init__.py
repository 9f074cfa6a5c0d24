"""Scalar and aggregate functions, all built from Spark's own."""
