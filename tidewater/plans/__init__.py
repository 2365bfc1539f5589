"""Registered queries over the driver tables (imports populate the registry)."""

from tidewater.plans import catalog, collect, dml, history, ingest, maintenance, pages, retrieval, streams  # noqa: F401
from tidewater.plans.registry import REGISTRY, Entry, query

__all__ = ["REGISTRY", "Entry", "query"]
