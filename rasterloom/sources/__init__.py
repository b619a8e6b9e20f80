"""Readers: CSV tables, file listings, ZIP archives and images."""
