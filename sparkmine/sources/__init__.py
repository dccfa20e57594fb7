"""Readers, writers and the example inputs derived from the driver tables."""
