"""Incremental intake of new files."""
