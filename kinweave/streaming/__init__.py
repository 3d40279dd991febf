"""Incremental linkage over streams."""
