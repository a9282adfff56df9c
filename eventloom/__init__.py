"""Spark-native analytics for user-activity events, in batch and as streams."""

__version__ = "0.1.0"
