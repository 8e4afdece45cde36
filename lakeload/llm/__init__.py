"""Operators for preparing training data: selection, deduplication, scanning, mixing, encoding."""
