"""Streamed landing, consume-once loads and merges of micro-batches."""
