"""Deterministic ids and content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from canonry.functions.text import SPACE


def entity_id(system: Column, record: Column) -> Column:
    """``law_`` and 24 hex digits of the hash of system and record."""
    return F.concat(F.lit("law_"), F.substring(F.sha2(F.concat(system, F.lit(":"), record), 256), 1, 24))


def family_id(ids: Column) -> Column:
    """Id of a family: its only member, or a hash of the sorted members."""
    return F.when(F.size(ids) == 1, F.concat(F.lit("id:"), ids[0])).otherwise(
        F.concat(F.lit("family:"), F.substring(F.sha1(F.array_join(F.array_sort(ids), "|")), 1, 20))
    )


def text_fingerprint(text: Column) -> Column:
    """Hash of a text with white space squeezed; white-space-only changes don't show."""
    return F.sha2(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " "), "^ | $", ""), 256)


def fields_fingerprint(**fields: Column) -> Column:
    """Hash of named values in the order of their names; nulls and blanks are left out."""
    parts = [F.when(F.length(v) > 0, F.concat(F.lit(f"{k}="), v)) for k, v in sorted(fields.items())]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)
