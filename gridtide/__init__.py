"""Spark-native analytics for electricity-market and weather time series."""
