"""Registered queries over the shared tables, each with equivalent SQL where it exists."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("scans", "writes", "marts", "times", "incremental")


def all_queries() -> tuple[dict, dict]:
    """Queries and SQL equivalents by name."""
    for name in _MODULES:
        import_module(f"tidemark.catalog.{name}")
    from tidemark.catalog.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
