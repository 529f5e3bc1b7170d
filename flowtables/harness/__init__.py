"""Queries over the driver tables, each with an independent SQL statement of its result."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("text", "billing", "deltas", "files", "flows")


def _load() -> None:
    for module in _MODULES:
        import_module(f"{__name__}.{module}")


def all_queries():
    from flowtables.harness.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles():
    from flowtables.harness.registry import ORACLES

    _load()
    return dict(ORACLES)
