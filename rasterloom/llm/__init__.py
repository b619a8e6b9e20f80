"""Operators for large text corpora; nothing outside this folder imports it."""
