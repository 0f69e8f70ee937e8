"""Warehouse models, the full build, and the query catalogue."""
