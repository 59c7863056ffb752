"""Keyed ingestion, table sync, enrichment, text analysis and delivery on Spark."""
