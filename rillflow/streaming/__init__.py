"""Spark-first content corpus engine: streaming."""
