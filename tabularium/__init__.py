"""Spark-native analytics over dated, imperfect register editions."""
