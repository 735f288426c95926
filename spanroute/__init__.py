"""Spark-native analytics for catalogues of places and services."""
