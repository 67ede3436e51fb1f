"""Readers, writers and the keyed library tables."""
