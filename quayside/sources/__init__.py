"""Readers; each gives a Batch."""
