"""Structured Streaming ingestion of indicator events."""
