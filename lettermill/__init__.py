"""Reduced-alphabet k-mer analytics as Spark DataFrame operations."""
