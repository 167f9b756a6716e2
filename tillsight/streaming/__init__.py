"""Structured Streaming form of the input path: incremental ingest of invoice files."""
