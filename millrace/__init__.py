"""Spark-native lakehouse for industrial sensor data."""
