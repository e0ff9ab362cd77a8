"""Readers and writers of the file formats the catalogue uses."""
