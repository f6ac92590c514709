"""Repeatable ingest with file-source streams."""
