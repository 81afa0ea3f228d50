"""Spark-native loading and analysis of a tiered star-schema warehouse."""
