"""Readers, writers, stored tables and topic records."""
