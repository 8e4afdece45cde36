"""Readers: delimited text and file listings."""
