"""File-arrival ingest as Structured Streaming."""
