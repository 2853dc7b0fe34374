"""Entity resolution: anchors within a band, and the fold of merged records."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canonry.operators import graph
from canonry.session import cut, release


def anchor_dedupe(df: DataFrame, keys: list[str], day: str, id_col: str, days: int = 3) -> DataFrame:
    """(id, anchor_id): each record joins the first anchor of its key within ``days`` (JN-02).

    Anchors are taken by day and id. The rule isn't transitive: A and C both near B make
    one group with anchor A only for those near A. Equal days are folded before any group
    meets in one task, so a task holds the distinct days of a key, however many its records.
    Records without a day, or with a null key, are their own anchors.
    """
    absent = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in [day, *keys]))
    spare = df.where(absent).select(F.col(id_col), F.col(id_col).alias("anchor_id"))
    known = df.where(F.col(day).isNotNull()).dropna(subset=keys)
    by_day = known.groupBy(*keys, day).agg(F.min(id_col).alias("_first"))

    # Days further apart than the band never share an anchor: they split a key into stretches,
    # and a stretch no longer than the band has its first day as the anchor.
    w = W.partitionBy(*keys).orderBy(day)
    fresh = F.coalesce((F.datediff(F.col(day), F.lag(day).over(w)) > days).cast("int"), F.lit(1))
    parts = by_day.withColumn("_fresh", fresh).withColumn("_part", F.sum("_fresh").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_fresh")
    each = W.partitionBy(*keys, "_part")
    spans = parts.withColumn("_from", F.min(F.struct(F.col(day).alias("d"), F.col("_first").alias("id"))).over(each)).withColumn("_to", F.max(day).over(each))
    wide = F.datediff("_to", "_from.d") > days
    short = spans.where(~wide).select(*keys, day, F.col("_from.id").alias("anchor_id"))

    def greedy(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(day).reset_index(drop=True)
        at, anchor, out = None, None, []
        for d, first in zip(pd.to_datetime(g[day]), g["_first"], strict=True):
            if at is None or (d - at).days > days:
                at, anchor = d, first
            out.append(anchor)
        return g[[*keys, day]].assign(anchor_id=out)

    types = dict(df.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in [*keys, day]) + f", anchor_id {types[id_col]}"
    anchored = spans.where(wide).select(*keys, "_part", day, "_first").groupBy(*keys, "_part").applyInPandas(greedy, schema)
    return known.join(short.unionAll(anchored), [*keys, day]).select(id_col, "anchor_id").unionByName(spare)


def fold(df: DataFrame, group: str, order: str, first_known: list[str], longest: list[str], union: list[str]) -> DataFrame:
    """One record per group (AGG-03): first known value, longest text, union of arrays.

    Blank and ``unknown`` count as absent. Everything is aggregated with partial results.
    """
    present = lambda c: F.nullif(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit("unknown"))
    picks = [F.min(F.when(present(c).isNotNull(), F.struct(F.col(order).alias("o"), present(c).alias("v")))).alias(c) for c in first_known]
    picks += [F.max(F.when(present(c).isNotNull(), F.struct(F.length(c).alias("o"), F.col(c).alias("v")))).alias(c) for c in longest]
    out = df.groupBy(group).agg(F.count(F.lit(1)).alias("merged"), *picks)
    out = out.select(group, "merged", *(F.col(f"{c}.v").alias(c) for c in [*first_known, *longest]))
    for c in union:  # values are made distinct before they gather, so an array holds each once
        held = df.select(group, F.explode(c).alias(c)).distinct().groupBy(F.col(group).alias("_g")).agg(F.array_sort(F.collect_list(c)).alias(c))
        out = out.join(held, out[group].eqNullSafe(held["_g"]), "left").drop("_g").withColumn(c, F.coalesce(c, F.array().cast(held.schema[c].dataType)))
    return out


def common_to_all(df: DataFrame, group: list[str], member: str, value: str) -> DataFrame:
    """(group, members, value): the values that every member of a group holds (AGG-20).

    A value is common where as many members hold it as the group has; both are counts with
    partial results, so no set gathers. Groups without a common value give no row; a null
    value is held by no member.
    """
    own = df.select(*group, member, value).distinct()
    size = own.groupBy(*group).agg(F.count_distinct(member).alias("members"))
    held = own.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    return held.join(size, group).where("_n = members").select(*group, "members", value)


def dedupe_passes(df: DataFrame, id_col: str, order: list[str], passes: list[list[str]]) -> DataFrame:
    """(id, kept_id, pass) of the records that merge in ordered passes (AGG-02).

    Each pass groups the survivors of the one before by its key columns; rows with a null
    key take no part, so blanks never make one giant group. A key column may be an array, as
    of addresses or digests: then a record is in the group of each value, and records that
    share values, directly or through others, merge in this pass. Kept is the first by
    ``order``, then by id. A record's kept one may itself merge in a later pass; the result
    follows that on, so every record ends at a survivor.
    """
    alive = cut(df.select(id_col, *dict.fromkeys([*order, *(k for p in passes for k in p)])))
    merged = None
    rank = F.struct(*order, id_col)
    for n, keys in enumerate(passes):
        arrays = [k for k in keys if alive.schema[k].dataType.typeName() == "array"]
        each = alive
        for k in arrays:
            each = each.withColumn(k, F.explode(F.array_distinct(k)))
        own = each.dropna(subset=keys)
        best = own.groupBy(*keys).agg(F.min(rank).alias("_best"), F.count(F.lit(1)).alias("_size")).where("_size > 1")
        near = own.join(best, keys).select(F.col(id_col).alias("a"), F.col(f"_best.{id_col}").alias("b")).where("a <> b").distinct()
        if arrays:  # groups of one pass overlap: of each component the first by order is kept
            of = graph.components(near)
            ranked = of.join(alive.select(F.col(id_col).alias("node"), *order), "node")
            first = ranked.groupBy("component").agg(F.min(F.struct(*order, "node")).alias("_b")).select("component", F.col("_b.node").alias("b"))
            near = of.join(first, "component").select(F.col("node").alias("a"), "b").where("a <> b")
        gone = cut(near.select(F.col("a").alias(id_col), F.col("b").alias("kept_id"), F.lit(n).alias("pass")))
        if merged is not None:  # those kept by an earlier pass that merge now
            on = gone.select(F.col(id_col).alias("_from"), F.col("kept_id").alias("_to"))
            merged = merged.join(on, merged["kept_id"] == on["_from"], "left").select(id_col, F.coalesce("_to", "kept_id").alias("kept_id"), "pass").unionByName(gone)
        else:
            merged = gone
        merged = cut(merged)
        before, alive = alive, cut(alive.join(gone.select(id_col), id_col, "left_anti"))
        release(before)
    release(alive)
    return merged


def unique_overlap(records: DataFrame, entities: DataFrame, record_id: str, entity_id: str, keys: str, agree: list[str]) -> DataFrame:
    """(record_id, entity_id) where exactly one entity shares a key and contradicts nothing (JN-05).

    ``keys`` is an array column on both sides; each of ``agree`` must be equal or missing on
    one side. If candidates share the first of ``agree``, only those count. An exploded
    equi-join instead of a scan of all entities per record.
    """
    r = records.select(record_id, *agree, F.explode(F.array_distinct(keys)).alias("_key"))
    e = entities.select(entity_id, *(F.col(c).alias(f"_{c}") for c in agree), F.explode(F.array_distinct(keys)).alias("_key"))
    fits = [F.coalesce(F.col(c) == F.col(f"_{c}"), F.lit(True)) for c in agree]
    joined = r.join(e, "_key")
    for f in fits:
        joined = joined.where(f)
    strong = F.coalesce(F.col(agree[0]) == F.col(f"_{agree[0]}"), F.lit(False)) if agree else F.lit(False)
    ends = joined.groupBy(record_id).agg(*(f(F.when(c, F.col(entity_id))).alias(n) for n, f, c in (("s0", F.min, strong), ("s1", F.max, strong), ("w0", F.min, F.lit(True)), ("w1", F.max, F.lit(True)))))
    one = F.when(F.col("s0").isNotNull(), F.when(F.col("s0") == F.col("s1"), F.col("s0"))).when(F.col("w0") == F.col("w1"), F.col("w0"))
    return ends.select(record_id, one.alias(entity_id)).where(F.col(entity_id).isNotNull())


def overlap_rounds(records: DataFrame, entities: DataFrame, record_id: str, entity_id: str, keys: str, agree: list[str], order: str) -> DataFrame:
    """(record_id, entity_id, round) of records merged into entities, blanks filled on the way (JN-05).

    A round merges what ``unique_overlap`` finds, at most one record per entity and blank: the
    first by ``order`` of each entity goes in, and with it the others that agree with it; the
    entity takes its keys and fills its blanks. Rounds go on until none merges anything, so a
    record that only fits what an earlier one filled in comes in a later round. All rounds are
    joins over all rows, no group is worked off in one task.
    """
    left, held, found, n = cut(records.select(record_id, order, keys, *agree)), cut(entities.select(entity_id, keys, *agree)), None, 0
    while True:
        pairs = unique_overlap(left, held, record_id, entity_id, keys, agree).join(left, record_id)
        first = pairs.groupBy(entity_id).agg(F.min(F.struct(F.col(order).alias("o"), F.col(record_id).alias("r"), *(F.col(c).alias(f"_{c}") for c in agree))).alias("_f"))
        fits = [F.coalesce(F.col(c) == F.col(f"_f._{c}"), F.lit(True)) for c in agree]
        # The first goes in, and those that fit it without adding what it lacks.
        adds = [F.col(c).isNotNull() & F.col(f"_f._{c}").isNull() & F.col(f"_h_{c}").isNull() for c in agree]
        now = pairs.join(first, entity_id).join(held.select(F.col(entity_id).alias("_e"), *(F.col(c).alias(f"_h_{c}") for c in agree)), F.col(entity_id) == F.col("_e"))
        own = F.col(record_id) == F.col("_f.r")
        ok = reduce(lambda a, b: a & b, fits, F.lit(True)) & ~reduce(lambda a, b: a | b, adds, F.lit(False))
        merged = cut(now.where(own | ok).select(record_id, entity_id, keys, *agree, own.alias("_own")))
        step = merged.select(record_id, entity_id, F.lit(n).alias("round"))
        if merged.isEmpty():
            release(left, held)
            return step if found is None else found  # an empty step stays, if it is all there is
        found = step if found is None else found.unionAll(step)
        fill = merged.where("_own").select(F.col(entity_id).alias("_e"), *(F.col(c).alias(f"_{c}") for c in agree))
        # Keys gather per entity; they are distinct first.
        more = merged.select(entity_id, F.explode(keys).alias("_k")).unionAll(held.select(entity_id, F.explode(keys).alias("_k"))).distinct().groupBy(F.col(entity_id).alias("_g")).agg(F.collect_list("_k").alias("_keys"))
        grown = held.join(fill, F.col(entity_id) == F.col("_e"), "left").join(more, F.col(entity_id) == F.col("_g"), "left")
        before, held = held, cut(grown.select(entity_id, F.coalesce("_keys", keys).alias(keys), *(F.coalesce(c, f"_{c}").alias(c) for c in agree)))
        rest, left = left, cut(left.join(merged.select(record_id), record_id, "left_anti"))
        release(before, rest)
        n += 1
