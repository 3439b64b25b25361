"""Operators for training-data pipelines: formatting, mixing, token counts, deduplication, search, packing, scans."""
