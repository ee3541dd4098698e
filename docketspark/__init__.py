"""Spark-native analytics over collections of case-law documents."""
