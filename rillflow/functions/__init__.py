"""Spark-first content corpus engine: functions."""
