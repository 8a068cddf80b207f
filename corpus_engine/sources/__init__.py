"""Readers and writers: landed pages, captions, subtitle files, versioned tables."""
