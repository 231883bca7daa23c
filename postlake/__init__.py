"""Spark-native store of social posts tagged with stock symbols."""
