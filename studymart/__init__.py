"""Spark-native analytics for overnight clinical studies."""

__version__ = "0.1.0"
