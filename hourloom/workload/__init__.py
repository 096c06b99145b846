"""Queries over the given tables, one or more for every operator."""

from __future__ import annotations

from types import ModuleType


def load() -> ModuleType:
    """Import every query module; returns the registry they filled."""
    from hourloom.workload import aggregates, daily, ingestion, joins, layouts, marts, refreshes, registry, rows, state, trees  # noqa: F401

    return registry
