"""Readers, writers and the versioned store."""
