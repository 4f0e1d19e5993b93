"""Readers, writers and the adapter from the sample tables."""
