"""Readers, writers (load modes) and the stand-in tables over the test data."""
