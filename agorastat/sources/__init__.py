"""Schemas, readers, writers and the shared scratch folder."""
