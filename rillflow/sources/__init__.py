"""Spark-first content corpus engine: sources."""
