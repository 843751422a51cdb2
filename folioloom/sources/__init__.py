"""Readers: explicit table schemas, EPUB archives, HTML listings."""
