"""Readers, payload normalisers and stage tables."""
