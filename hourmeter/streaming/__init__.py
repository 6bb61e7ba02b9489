"""Incremental ingest from a drop folder (K1) and replay of quarantined lines (K6)."""
