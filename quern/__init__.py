"""Spark-native analytics for language-model training data."""
