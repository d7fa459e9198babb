"""Readers, writers and stored fitted tables."""
