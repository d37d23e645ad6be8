"""Operators for preparing training text, each usable alone, and their queries."""
