"""Spark-native analytics for panels of regional time series."""
