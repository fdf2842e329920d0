"""Spark-native engine for annotated text corpora."""
