"""Ingesting files as they arrive."""

from .arrivals import ingest_arrivals

__all__ = ["ingest_arrivals"]
