"""Spark-native building, querying and checking of variant-annotation tables."""
