"""Collects every plan module's registered queries."""

from __future__ import annotations

import importlib

from cairn.plans import _registry

_MODULES = (
    "order_analytics",
    "flight_analytics",
    "retail",
    "relational",
    "shaping",
    "mixed_nested",
    "io_sources",
    "catalog_tables",
    "incremental_jobs",
    "jobs",
)

_loaded = False


def _load():
    global _loaded
    if not _loaded:
        for m in _MODULES:
            importlib.import_module(f"cairn.plans.{m}")
        _loaded = True


def queries():
    _load()
    return dict(_registry.QUERIES)


def oracle_sql():
    _load()
    return dict(_registry.ORACLE)
