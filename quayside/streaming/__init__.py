"""Structured Streaming runs: landed documents and the usage counter."""
