"""Lectern: content-store, deck-extraction and curriculum analytics as Spark DataFrame jobs."""
