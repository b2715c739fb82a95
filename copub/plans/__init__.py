"""Fixtures derived from the test tables and the registered query catalog."""
