"""Spark-first compiler and query layer for ordered two-level text corpora."""
