"""Readers, writers and listing helpers."""
