"""Readers: raw JSON files, the catalogue of files and the partitioned store."""
