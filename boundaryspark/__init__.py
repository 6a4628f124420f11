"""Spark-native processing of administrative boundary layers."""
