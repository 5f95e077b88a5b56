"""Incrementally maintained results."""
