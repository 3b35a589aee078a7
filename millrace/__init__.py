"""Data ingestion and table maintenance on Spark."""
