"""Spark-native ingestion and querying of semi-structured event feeds."""
