"""Queries over the given tables, each with the SQL text it must agree with."""

from __future__ import annotations

from importlib import import_module

_MODULES = (
    "queries_rollups", "queries_exports", "queries_monitor", "queries_catalog", "queries_spatial", "queries_ingest",
    "queries_files",
)


def catalog_of_queries() -> dict:
    """All registered queries by name."""
    from airloom.plans.registry import REGISTRY

    for module in _MODULES:
        import_module(f"{__name__}.{module}")
    return REGISTRY
