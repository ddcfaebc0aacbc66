"""Unbounded sources."""
