"""Spark-native processing of station-based weather time series."""
