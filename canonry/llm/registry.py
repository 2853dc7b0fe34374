"""Queries of the subpackage and the SQL to check them with."""

from __future__ import annotations

import importlib

#: Modules of the problems; each may define QUERIES and SQL. They are imported with this one,
#: so whatever a module lacks shows where the subpackage is imported.
MODULES = [
    importlib.import_module(f"canonry.llm.{name}")
    for name in ("p1_pages", "p2_near", "p3_match", "p4_survivor", "p5_groups", "p6_scans", "p7_encoding", "p8_tokens", "p9_leaks", "p10_quality")
]


def _gather(attribute: str) -> dict:
    return {name: x for module in MODULES for name, x in getattr(module, attribute, {}).items()}


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict:
    return _gather("SQL")
