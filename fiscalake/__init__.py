"""Spark-native lakehouse for municipal public-finance data."""
