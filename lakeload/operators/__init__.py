"""Sinks, catalog access and load checks."""
