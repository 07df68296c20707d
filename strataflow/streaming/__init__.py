"""Continuous ingestion."""
