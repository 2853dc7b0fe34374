"""Graph operators over edge tables: components, mirrors and degrees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonry.session import cut, release

#: Links of one node that share a salt.
LINKS_PER_SALT = 100_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of undirected edges (a, b): the smallest node of each component.

    Alternating large and small stars (the published two-phase MapReduce scheme): every
    step points nodes at smaller ones until all point at the smallest, in logarithmically
    many rounds for any shape. Each round's edges are written, so no lineage grows. Hubs are
    salted: a node with many links is joined with its smallest in several tasks. Two rounds
    are equal where count and sum of hashes of their distinct edges are.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    held: list[DataFrame] = []
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    now = state(edges)

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.ceil(F.count(F.lit(1)) / LINKS_PER_SALT).cast("int").alias("salts"))
        low = least.select("u", F.least("u", "m").alias("m"), "salts")
        if 4 * now[0] <= LINKS_PER_SALT:  # a star has at most twice the edges, seen from both ends: no node can be a hub
            linked = both.join(low, "u").select("u", "v", "m")
        else:
            low = cut(low)
            held.append(low)
            hubs = low.where("salts > 1").select("u", "salts")  # at most the links / LINKS_PER_SALT
            salted = both.join(F.broadcast(hubs), "u", "left").select("u", "v", F.pmod(F.xxhash64("v"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
            spread = low.select("u", "m", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
            linked = salted.join(spread, ["u", "salt"]).select("u", "v", "m")
        if large:
            return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        own = low.where("u <> m").select("u", F.col("m").alias("v"))
        return linked.where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).unionAll(own).where("u <> v").distinct()

    while True:
        large = cut(star(edges, True))
        after = cut(star(large, False))
        release(edges, large, *held)
        held.clear()
        edges, before, now = after, now, state(after)
        if now == before:
            break
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def mirror(edges: DataFrame) -> DataFrame:
    """Each edge from both of its ends: node, direction, relation and counterpart (AGG-09)."""
    out = edges.select(F.col("from_id").alias("node"), F.lit("outgoing").alias("direction"), "relation", F.col("to_id").alias("counterpart"))
    return out.unionAll(edges.select(F.col("to_id").alias("node"), F.lit("incoming").alias("direction"), "relation", F.col("from_id").alias("counterpart")))
