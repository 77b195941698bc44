"""Spark-native lifecycle for tabular regression: clean, watch, train, score, govern."""
