"""Incremental jobs."""
