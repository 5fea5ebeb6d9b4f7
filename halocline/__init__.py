"""Spark-native analytics for profiling-instrument logs, and operators for large text corpora."""
