"""Incremental (file source) jobs."""
