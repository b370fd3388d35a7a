"""Readers, writers and the data-set catalogue."""
