"""Readers, writers and the feed that maps the test tables onto the raw and star schemas."""
