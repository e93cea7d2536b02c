"""Readers of raw inputs, writers and readers of layered tables."""
