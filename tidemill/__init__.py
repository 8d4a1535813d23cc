"""Spark-native telemetry analytics: landing, silver, gold, features and ML jobs."""
