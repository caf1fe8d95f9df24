"""Readers: driver tables, stand-in domain tables and documents, JSON payloads."""
