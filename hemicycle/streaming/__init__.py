"""Incremental runs over files as they land."""
