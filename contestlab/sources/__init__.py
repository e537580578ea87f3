"""Readers and the shared scratch folder."""
