"""Readers and writers of landing zones and tables."""
