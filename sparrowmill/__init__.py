"""Spark-first corpus preparation, audits, metrics and streams."""
