"""Structured Streaming forms of ingest, revenue, stock and RFM."""
