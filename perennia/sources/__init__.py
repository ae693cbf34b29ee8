"""Readers, writers, schemas and the shared scratch folder."""
