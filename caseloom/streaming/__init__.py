"""Incremental runs over append-only logs."""
