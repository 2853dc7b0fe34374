"""Queries of the core operators and the SQL to check them with."""

from __future__ import annotations

import importlib

#: Modules that define QUERIES (name to function of session and folder) and SQL (name to DuckDB text).
MODULES = ["plans.duplicates", "plans.scalars", "plans.relations", "plans.records", "plans.pages", "plans.resolution", "plans.lineage", "plans.texts", "plans.landing"]


def _gather(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(importlib.import_module(f"canonry.{name}"), attribute, {})
    return out


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict:
    return _gather("SQL")
