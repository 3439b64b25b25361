"""Whole jobs composed from operators, and the registry of queries over the sample tables."""
