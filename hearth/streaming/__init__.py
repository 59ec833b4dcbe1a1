"""Structured Streaming versions of the ingest steps (micro-batch upsert, current view, alerts)."""
