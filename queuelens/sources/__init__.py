"""Readers, writers and the embedding store."""
