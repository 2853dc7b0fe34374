"""Data-quality checks as issue tables: check, key, detail (VAL)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _issue(df: DataFrame, check: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check_id"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def unique(df: DataFrame, key: str, check: str) -> DataFrame:
    """Keys on more than one row."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col(key).isNotNull())
    return _issue(n, check, F.col(key), F.col("n"))


def foreign(df: DataFrame, key: str, other: DataFrame, other_key: str, check: str) -> DataFrame:
    """Values that the other table lacks, with how many rows have them."""
    known = other.select(F.col(other_key).alias(key)).distinct()
    n = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return _issue(n.join(known, key, "left_anti"), check, F.col(key), F.col("n"))


def required(df: DataFrame, key: str, columns: list[str], check: str) -> DataFrame:
    """Rows that lack a required value; null and blank count as absent."""
    absent = F.array_compact(F.array(*(F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in columns)))
    return _issue(df.withColumn("_absent", absent).where(F.size("_absent") > 0), check, F.col(key), F.array_join("_absent", ","))


def allowed(df: DataFrame, key: str, column: str, values: list[str], check: str) -> DataFrame:
    """Rows whose value isn't one of those allowed."""
    return _issue(df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)), check, F.col(key), F.col(column))


def mismatches(a: DataFrame, b: DataFrame, key: str, columns: list[str], check: str) -> DataFrame:
    """Keys whose rows differ between two tables, or that one lacks (VAL-10): the fields that differ."""
    x = a.select(key, *(F.col(c).alias(f"_a_{c}") for c in columns), F.lit(1).alias("_in_a"))
    y = b.select(key, *(F.col(c).alias(f"_b_{c}") for c in columns), F.lit(1).alias("_in_b"))
    differ = F.array_compact(F.array(*(F.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), F.lit(c)) for c in columns)))
    what = F.when(F.col("_in_a").isNull(), F.array(F.lit("extra"))).when(F.col("_in_b").isNull(), F.array(F.lit("missing"))).otherwise(differ)
    return _issue(x.join(y, key, "full_outer").withColumn("_what", what).where(F.size("_what") > 0), check, F.col(key), F.array_join("_what", ","))


def unmirrored(stored: DataFrame, expected: DataFrame, columns: list[str]) -> DataFrame:
    """References that one side has and the other lacks (VAL-04): the columns and ``side``,
    ``missing`` where a stored one isn't expected, ``extra`` the other way round.

    Set semantics: repeated references count once; nulls equal nulls.
    """
    x, y = stored.select(*columns).distinct(), expected.select(*columns).distinct()
    return x.exceptAll(y).withColumn("side", F.lit("missing")).unionAll(y.exceptAll(x).withColumn("side", F.lit("extra")))


def exactly_one(keys: DataFrame, key: str, rows: DataFrame, check: str) -> DataFrame:
    """Keys that ``rows`` has not exactly once (VAL-05), with how often it has them."""
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return _issue(keys.select(key).distinct().join(n, key, "left").where(F.coalesce("n", F.lit(0)) != 1), check, F.col(key), F.coalesce("n", F.lit(0)))


def contract(df: DataFrame, key: str, types: dict[str, str], needed: list[str], values: dict[str, list[str]]) -> DataFrame:
    """Breaches of a table's contract (VAL-01): columns that lack or have another type (key is
    the column), rows without a required value, and values that aren't allowed."""
    have = dict(df.dtypes)
    wrong = [("column_missing", c, t) for c, t in types.items() if c not in have] + [("column_type", c, have[c]) for c, t in types.items() if c in have and have[c] != t]
    issues = df.sparkSession.createDataFrame(wrong, "check_id string, key string, detail string")
    issues = issues.unionAll(required(df, key, [c for c in needed if c in have], "required"))
    for c, allow in values.items():
        if c in have:
            issues = issues.unionAll(allowed(df, key, c, allow, f"enum_{c}"))
    return issues


def contradictions(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """Rows in which a rule that must never hold does (VAL-03), an issue for each rule."""
    held = F.explode(F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in rules.items()))))
    return df.select(F.col(key).cast("string").alias("key"), held.alias("check_id")).select("check_id", "key", F.lit(None).cast("string").alias("detail"))


def normalized(df: DataFrame, key: str, text: str, assets: str, files: DataFrame, file: str) -> DataFrame:
    """Faults of a normalised layer (VAL-06): empty texts, markup left in them, assets without a file."""
    from canonry.functions.text import blank

    empty = _issue(df.where(blank(F.col(text))), "empty_text", F.col(key), F.lit(None))
    left = F.regexp_extract(text, "</?(?:p|div|span|br|table|tr|td|a|img|script|style|ul|li)(?:\\s[^<>]*)?/?>", 0)
    tags = _issue(df.withColumn("_tag", left).where("_tag <> ''"), "markup_left", F.col(key), F.col("_tag"))
    named = df.select(F.col(key), F.explode(assets).alias("_file")).where("_file is not null").distinct()
    there = files.select(F.col(file).alias("_file")).distinct()
    return empty.unionAll(tags).unionAll(_issue(named.join(there, "_file", "left_anti"), "asset_missing", F.col(key), F.col("_file")))


def subset(df: DataFrame, group: str, value: str, needed: list[str], check: str) -> DataFrame:
    """Groups that lack one of the values needed (SET-04), an issue for each.

    A group's set holds needed values only, so it is no larger than the list.
    """
    have = df.groupBy(group).agg(F.collect_set(F.when(F.col(value).isin(needed), F.col(value))).alias("_have"))
    lack = have.select(group, F.explode(F.array_except(F.array(*map(F.lit, needed)), "_have")).alias("_lack"))
    return _issue(lack, check, F.col(group), F.col("_lack"))


def enumeration(pages: DataFrame, group: str, page: str, reported: str, size: int | None = None) -> DataFrame:
    """Enumerations that aren't complete (VAL-09): pages that lack, repeat or count from another
    number than 1, totals that differ, and pages but the last that aren't full.

    ``pages`` has a row per item: group, page and the total reported with it.
    """
    per = pages.groupBy(group, page).agg(F.count(F.lit(1)).alias("_n"), F.min(reported).alias("_r0"), F.max(reported).alias("_r1"))
    full = F.when(F.lit(size is not None), F.lit(size or 0))
    whole = per.groupBy(group).agg(
        F.count(F.lit(1)).alias("pages"), F.min(page).alias("first"), F.max(page).alias("last"), F.sum("_n").alias("items"), F.min("_r0").alias("r0"), F.max("_r1").alias("r1"),
        F.sum(F.when(F.col("_n") != full, 1).otherwise(0)).alias("short"), F.max_by("_n", page).alias("tail"),
    )
    uneven = F.lit(size is not None) & ((F.col("short") > 1) | ((F.col("short") == 1) & (F.col("tail") == full)))
    return contradictions(whole, group, {"page_gap": (F.col("first") != 1) | (F.col("last") != F.col("pages")), "total_differs": (F.col("r0") != F.col("r1")) | (F.col("items") != F.col("r1")), "page_size": uneven})
