"""Operators for large text corpora, on Spark: filters, duplicates, packing, token files."""
