"""Operators: ingest, window counts, ranking, late data."""
