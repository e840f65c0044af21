"""Readers: RAW archive, derived tables, schema catalog."""
