"""Structured Streaming forms of the ingest and alert jobs."""
