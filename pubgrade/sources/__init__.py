"""Readers, writers and stored states."""
