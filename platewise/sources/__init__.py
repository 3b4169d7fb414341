"""Schemas, readers, writers and the staging layer."""
