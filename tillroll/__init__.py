"""Retail customer-value and basket analytics as PySpark DataFrame jobs."""
