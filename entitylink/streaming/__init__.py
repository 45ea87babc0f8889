"""Incremental matching over arriving source-1 files."""
