"""Ingest jobs: documents ``(entry, body)`` to the typed raw tables of a feed."""

from rostrum.ingest.feeds import INGEST, Feed, feed

__all__ = ["INGEST", "Feed", "feed"]
