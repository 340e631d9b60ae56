"""Readers: database tables, product files, lists, saved predictions, star-schema tables."""
