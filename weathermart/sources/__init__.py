"""Readers, writers and the raw-layer landing steps."""
