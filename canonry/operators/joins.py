"""Joins that no single Spark join expresses: by priority, as of, unique, and with stand-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def priority_match(probes: DataFrame, primary: DataFrame, key: str, number: str, day: str, primary_id: str, probe_id: str, days: int = 3) -> DataFrame:
    """At most one primary record per probe (JN-01), with the rule that decided and its confidence.

    Candidates share ``key``. None: ``new``. Exactly one with the same number: ``same``.
    Else the nearest within ``days``: ``near_date``. Else a single candidate:
    ``only_candidate``. Else ``ambiguous``, without an id. Null keys have no candidates;
    ties in distance go to the smaller id. One aggregation per probe, pre-aggregated before
    the shuffle, so a key with very many candidates never gathers in one task.
    """
    p = primary.select(F.col(primary_id).alias("_id"), F.col(key).alias("_key"), F.col(number).alias("_number"), F.col(day).alias("_day")).where("_key is not null")
    joined = probes.join(p, probes[key] == p["_key"], "left")
    apart = F.abs(F.datediff(F.col(day), F.col("_day")))
    same = F.coalesce(F.col(number) == F.col("_number"), F.lit(False))
    found = joined.groupBy(probe_id).agg(
        F.count("_id").alias("candidates"),
        F.count_if(same).alias("same"),
        F.min(F.when(same, F.col("_id"))).alias("same_id"),
        F.min(F.when(apart <= days, F.struct(apart.alias("apart"), F.col("_id").alias("id")))).alias("near"),
        F.min("_id").alias("only_id"),
    )
    rule = (
        F.when(F.col("candidates") == 0, "new").when(F.col("same") == 1, "same").when(F.col("near").isNotNull(), "near_date").when(F.col("candidates") == 1, "only_candidate").otherwise("ambiguous")
    )
    matched = F.when(rule == "same", F.col("same_id")).when(rule == "near_date", F.col("near.id")).when(rule == "only_candidate", F.col("only_id"))
    sure = F.create_map(*(F.lit(x) for pair in {"new": 1.0, "same": 1.0, "near_date": 0.99, "only_candidate": 0.92, "ambiguous": 0.4}.items() for x in pair))
    return found.select(probe_id, matched.alias("match_id"), rule.alias("rule"), sure[rule].alias("confidence"))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, right_id: str, forward: bool = True, unique: bool = False) -> DataFrame:
    """``left`` with the id of the first later (``forward``) or last earlier row of ``right``.

    Strictly later or earlier. With ``unique`` a tie at that time gives no id (JN-11b), else
    the smallest (JN-08). Both sides go through one window over the union, not a join of
    all pairs: a key's rows are sorted once, and a running value carries the nearest row.
    """
    nearest = right.where(F.col(right_time).isNotNull()).groupBy(*keys, F.col(right_time).alias("_t")).agg(F.min(right_id).alias("_id"), F.count(F.lit(1)).alias("_n"))
    rows = left.withColumn("_t", F.col(left_time)).withColumn("_side", F.lit(1))
    both = rows.unionByName(nearest.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    # The side with candidates comes after rows of its own time, so it isn't its own successor.
    time = F.col("_t").asc() if not forward else F.col("_t").desc()
    frame = W.partitionBy(*keys).orderBy(time, F.col("_side").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = F.last(F.when(F.col("_side") == 0, F.struct(F.col("_t").alias("t"), F.col("_id").alias("id"), F.col("_n").alias("n"))), ignorenulls=True).over(frame)
    out = both.withColumn("_hit", seen).where("_side = 1")
    hit = F.col("_t").isNotNull() & ((F.col("_hit.n") == 1) if unique else F.lit(True))
    return out.select(*left.columns, F.when(hit, F.col("_hit.id")).alias("as_of_id"))


def unique_match(left: DataFrame, right: DataFrame, condition: Column, left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id) where exactly one row of ``right`` meets the condition (JN-07, JN-09).

    For any condition; where it is equal keys and an order in time, ``unique_later`` needs
    no pairs.
    """
    n = left.join(right, condition).groupBy(left_id).agg(F.min(right_id).alias(right_id), F.max(right_id).alias("_other"))
    return n.where(F.col(right_id) == F.col("_other")).select(left_id, right_id)


def unique_later(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id) where exactly one row of ``right`` has the keys and no earlier time (JN-09).

    One of several is out as soon as the last but one time isn't earlier, so of each key only
    the last row and the last but one time count, which one aggregation gives: a key with very
    many rows on both sides never multiplies.
    """
    by_time = right.where(F.col(right_time).isNotNull()).groupBy(*keys, right_time).agg(F.min(right_id).alias("_a"), F.count(F.lit(1)).alias("_n"))
    last = by_time.groupBy(*keys).agg(F.max(F.struct(F.col(right_time).alias("t"), F.col("_a").alias("id"), F.col("_n").alias("n"))).alias("_last"))
    joined = by_time.join(last, keys)
    second = joined.groupBy(*keys).agg(F.first("_last").alias("_last"), F.max(F.when(F.col(right_time) < F.col("_last.t"), F.col(right_time))).alias("_second"))
    hit = left.join(second, keys).where((F.col("_last.n") == 1) & (F.col("_last.t") >= F.col(left_time)) & F.coalesce(F.col("_second") < F.col(left_time), F.lit(True)))
    return hit.select(left_id, F.col("_last.id").alias(right_id))


def with_stubs(edges: DataFrame, nodes: DataFrame, end: str, node_id: str) -> DataFrame:
    """One node per end of an edge, a stub where the node table has none (JN-14)."""
    known = nodes.select(F.col(node_id).alias("_known")).distinct()
    ends = edges.select(F.col(end).alias("node_id")).where("node_id is not null").distinct()
    return ends.join(known, ends["node_id"] == known["_known"], "left").select("node_id", F.col("_known").isNull().alias("is_stub"))


def first_wins(edges: DataFrame, key: list[str], priority: list[Column]) -> DataFrame:
    """The first edge of each key by priority (JN-16, JN-17), by one aggregation."""
    rest = [c for c in edges.columns if c not in key]
    order = F.struct(*(p.alias(f"_p{i}") for i, p in enumerate(priority)), *rest)
    return edges.groupBy(*key).agg(F.min(order).alias("_first")).select(*key, *(F.col(f"_first.{c}").alias(c) for c in rest))


def chain_edges(chains: DataFrame, chain: str, position: str, keys: list[str], entities: DataFrame, entity_id: str) -> DataFrame:
    """Edges between consecutive items of configured chains (JN-12): chain, from (newer), to (older).

    Items are found by ``keys``; where a key names several entities the last id counts. The
    older item must exist, the newer may be unknown and then has no id.
    """
    known = entities.groupBy(*keys).agg(F.max(entity_id).alias("_id"))
    w = W.partitionBy(chain).orderBy(position)
    found = chains.join(known, keys, "left").select(chain, position, "_id")
    pair = found.withColumn("to_id", F.lag("_id").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    return pair.where(~F.col("_first") & F.col("to_id").isNotNull()).select(chain, F.col("_id").alias("from_id"), "to_id")


def resolve_documents(refs: DataFrame, source_map: DataFrame, document: str, keys: list[str], entity_id: str) -> DataFrame:
    """Configured documents with the one entity their sources map to (JN-13): document, entity,
    and ``conflict`` where the sources map to several, which is an error of the configuration."""
    hit = refs.join(source_map.select(*keys, entity_id).distinct(), keys, "left")
    n = hit.groupBy(document).agg(F.min(entity_id).alias("_a"), F.max(entity_id).alias("_b"))
    return n.select(document, F.when(F.col("_a") == F.col("_b"), F.col("_a")).alias(entity_id), F.coalesce(F.col("_a") != F.col("_b"), F.lit(False)).alias("conflict"))


def clause_targets(texts: DataFrame, text_id: str, text: str, verbs: str, titles: DataFrame, title_key: str, target_id: str, key_of) -> DataFrame:
    """(text_id, target_id, title): titles quoted in a clause with one of ``verbs``, resolved by a
    unique key (JN-07, JN-11). Never the text itself; each pair once.

    A clause is what lies between full stops, semicolons and line ends.
    """
    clauses = F.explode(F.filter(F.split(F.col(text), "[。；;！？!?\n]"), lambda c: c.rlike(verbs) & F.contains(c, F.lit("《"))))
    quoted = F.explode(F.array_distinct(F.regexp_extract_all("_clause", F.lit("《([^《》]{4,120})》"), 1)))
    named = texts.select(F.col(text_id).alias("_text"), clauses.alias("_clause")).select("_text", quoted.alias("title")).withColumn("_key", key_of(F.col("title")))
    known = titles.groupBy(F.col(title_key).alias("_key")).agg(F.min(target_id).alias("_a"), F.max(target_id).alias("_b")).where("_a = _b and _key <> ''")
    return named.join(known, "_key").where("_text <> _a").select(F.col("_text").alias(text_id), F.col("_a").alias(target_id), "title").distinct()
