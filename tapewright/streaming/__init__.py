"""Incremental forms of ingest, dedupe, merge, window counts and alerts."""
