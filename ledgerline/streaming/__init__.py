"""Incremental runs over arriving files."""
