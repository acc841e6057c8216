"""Incremental ingest of newly arrived observation files."""

from .incremental import ingest_new_measurements

__all__ = ["ingest_new_measurements"]
