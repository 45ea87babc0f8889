"""Relational operators of the matching pipeline."""
