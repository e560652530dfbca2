"""Spark-native analytics for time-stamped observations."""
