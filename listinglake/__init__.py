"""Spark-native analytics over landed property-listing responses."""
