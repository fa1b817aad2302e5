"""Incremental forms of the ingest path."""
