"""Spark-native preparation, structuring and profiling of source-code corpora."""
