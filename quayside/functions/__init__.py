"""Scalar functions on names and texts."""
