"""Readers and writers of catalogue files and tables."""
