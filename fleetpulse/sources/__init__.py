"""Schemas, readers, writers, keyed state and table definitions."""
