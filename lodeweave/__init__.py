"""Spark-first engine for building, auditing and releasing text corpora."""
