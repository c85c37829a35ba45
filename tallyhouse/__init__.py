"""Merchant analytics as plain Spark DataFrame jobs."""
