"""Streaming ingestion."""
