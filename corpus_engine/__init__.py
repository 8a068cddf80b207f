"""Spark jobs that build and audit an online-media research corpus."""

__version__ = "0.1.0"
