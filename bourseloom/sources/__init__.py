"""Readers, writers and stand-in views over the given tables."""
