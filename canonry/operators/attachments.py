"""Attachments and the pages they belong to; bodies that several records share (JN-04, JN-06, AGG-04, AGG-08)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canonry.functions.text import clean_title, normal_title, quoted_titles
from canonry.operators import graph


def carriers(children: DataFrame, parents: DataFrame, child_id: str, parent_id: str, alike: Column, not_title: str) -> DataFrame:
    """(child_id, parent_id) of attachments that are their page's document (JN-04).

    The page has exactly one asset, which is the child; both have the same day; its title
    doesn't match ``not_title`` (a mere delivery notice); and ``alike`` holds, which may name
    the page's columns with ``p_`` before them. Nulls match nothing.
    """
    p = parents.select(*(F.col(c).alias(f"p_{c}") for c in parents.columns))
    single = p.where((F.size("p_assets") == 1) & ~F.coalesce(F.col("p_title").rlike(not_title), F.lit(False)))
    joined = children.join(single, (F.col(parent_id) == F.col(f"p_{parent_id}")) & (F.col("p_assets")[0] == F.col(child_id)) & (F.col("day") == F.col("p_day")))
    return joined.where(F.coalesce(alike, F.lit(False))).select(child_id, parent_id).distinct()


def mapped_edges(edges: DataFrame, source_map: DataFrame, ends: list[tuple[list[str], str]], keys: list[str], entity: str) -> DataFrame:
    """(from_id, to_id) of edges between records, with the entities that both map to (JN-06).

    ``ends`` names for each side the columns that stand for ``keys`` of the map. Edges with an
    unmapped end, and those within one entity, are left out; each comes once.
    """
    for i, (columns, name) in enumerate(ends):
        m = source_map.select(*(F.col(k).alias(f"_m{i}_{k}") for k in keys), F.col(entity).alias(name)).distinct()
        on = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"_m{i}_{k}") for c, k in zip(columns, keys, strict=True)))
        edges = edges.join(m, on)
    return edges.select(*(name for _, name in ends)).where(F.col(ends[0][1]) != F.col(ends[1][1])).distinct()


def shared_announcements(docs: DataFrame, doc_id: str, title: str, body: str, body_key: str, publishes: str) -> DataFrame:
    """(doc_id, body_key, length) of records whose body is the announcement of several (AGG-04).

    Records with one body key share a body; it is an announcement if it holds a verb of
    publishing, quotes at least two titles, the records have at least two titles, and at
    least two of them are named in it. Each record is judged by its own copy of the body, so
    the groups are made of counts and no body moves.
    """
    name = F.split(clean_title(F.col(title)), "[（(]")[0]
    named = (F.length(name) > 0) & F.contains(normal_title(F.col(body)), normal_title(name))
    own = docs.where(F.col(body_key).isNotNull()).select(
        doc_id, body_key, F.col(title).alias("_t"), F.length(body).alias("length"), named.alias("_named"), (F.col(body).rlike(publishes) & (F.size(quoted_titles(F.col(body))) >= 2)).alias("_says")
    )
    g = own.groupBy(body_key).agg(F.count_distinct("_t").alias("titles"), F.count_if("_named").alias("named"), F.bool_or("_says").alias("says")).where("titles >= 2 and named >= 2 and says")
    return own.join(g.select(body_key), body_key).select(doc_id, body_key, "length")


def case_groups(edges: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
    """(node, case_id, size) of all nodes by the edges (a, b) between them (AGG-08).

    Edges with an end that is no node count for nothing; a node without edges is a case of
    its own; a case is named after its least node.
    """
    own = nodes.select(F.col(node).alias("node")).where("node is not null").distinct()
    inside = edges.join(own.withColumnRenamed("node", "a"), "a", "left_semi").join(own.withColumnRenamed("node", "b"), "b", "left_semi")
    found = graph.components(inside.select("a", "b"))
    named = own.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("case_id"))
    size = named.groupBy("case_id").agg(F.count(F.lit(1)).alias("size"))
    return named.join(size, "case_id").select(F.col("node").alias(node), "case_id", "size")
