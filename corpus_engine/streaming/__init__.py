"""Incremental runs over a growing landing folder."""
