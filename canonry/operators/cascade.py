"""Ordered rule cascades: the first rule that holds decides, and says so."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A branch: what it yields where its condition holds, and how sure it is."""

    rule_id: str
    condition: Column
    outcome: str | None
    confidence: float


def decide(rules: list[Rule], default: Rule) -> Column:
    """Struct of outcome, rule_id and confidence of the first rule that holds."""
    made = lambda r: F.struct(F.lit(r.outcome).cast("string").alias("outcome"), F.lit(r.rule_id).alias("rule_id"), F.lit(r.confidence).alias("confidence"))
    out = None
    for r in rules:
        out = F.when(r.condition, made(r)) if out is None else out.when(r.condition, made(r))
    return made(default) if out is None else out.otherwise(made(default))


def reasons(checks: dict[str, Column]) -> Column:
    """Names of all checks that hold, in order: the reasons of a review queue."""
    return F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in checks.items())))
