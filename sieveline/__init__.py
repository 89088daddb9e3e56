"""Spark-native abuse-investigation analytics over security telemetry tables."""
