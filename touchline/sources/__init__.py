"""Readers and writers at the edges: CSV, ragged text, HTML pages, JSON records."""
