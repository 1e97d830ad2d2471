"""Structured Streaming versions of the windows, ingest, publishing, state and archive."""
