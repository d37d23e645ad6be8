"""Readers of raw text and of published tables."""
