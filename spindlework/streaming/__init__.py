"""Structured Streaming: ingest, keyed store, relay, scoring."""
