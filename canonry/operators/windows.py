"""Window operators: islands, ordinals, versions, collisions and the row that is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canonry.session import cut


def islands(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Runs of rows whose values count up by one (WIN-04): keys, first, last, length, begin."""
    w = W.partitionBy(*keys).orderBy(order)
    fresh = F.coalesce((F.col(value) != F.lag(value).over(w) + 1).cast("int"), F.lit(1))
    numbered = df.withColumn("_fresh", fresh).withColumn("_run", F.sum("_fresh").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_run").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count(F.lit(1)).alias("length"), F.min(order).alias("begin")).drop("_run")


def version_edges(df: DataFrame, family: str, version: Column, id_col: str) -> DataFrame:
    """(from_id, to_id) of each version and the next older one of its family (WIN-01).

    Unknown and equal versions give no edge.
    """
    known = df.select(family, F.col(id_col).alias("_id"), version.alias("_v")).where("_v > 0")
    w = W.partitionBy(family).orderBy(F.col("_v").desc(), "_id")
    pair = known.withColumn("_older", F.lead(F.struct("_id", "_v")).over(w))
    return pair.where(F.col("_older._v") < F.col("_v")).select(F.col("_id").alias("from_id"), F.col("_older._id").alias("to_id"), F.col(family))


def ranked(df: DataFrame, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """``df`` with ``rank``, from 1 in ``order`` over all rows or within each key, in no single task.

    Rows are sorted by ranges over all tasks; a row's rank is its place in its task plus the
    rows of its key in the tasks before, of which there is one count per task and key.
    """
    keys = keys or []
    placed = cut(df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(*keys, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    # A row per task and key: a key's rows here are at most the tasks it spans.
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = placed.withColumn("_part", part)
    same = [joined[k].eqNullSafe(offsets[k]) for k in keys] + [joined["_part"] == offsets["_part"]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return joined.join(offsets, on).select(*(joined[c] for c in df.columns), (F.col("_off") + F.col("_place") - F.col("_first") + 1).alias("rank"))


def suffixed(df: DataFrame, stem: str, id_col: str) -> DataFrame:
    """A name per row: the first of a stem keeps it, the others add 8 digits of their id's hash
    and, where even that collides, a number (WIN-06).

    The first of a stem comes from an aggregation, so a stem that very many rows share (as
    that of untitled ones) is in no single task; only rows whose hashes collide are numbered.
    """
    first = df.groupBy(stem).agg(F.min(id_col).alias("_least"))
    own = df.join(first, df[stem].eqNullSafe(first[stem])).drop(first[stem])
    named = own.withColumn("_name", F.when(F.col(id_col) == F.col("_least"), F.col(stem)).otherwise(F.concat(F.col(stem), F.lit(" - "), F.substring(F.sha2(F.col(id_col).cast("string"), 256), 1, 8)))).drop("_least")
    again = F.row_number().over(W.partitionBy("_name").orderBy(id_col))
    return named.withColumn("file_name", F.when(again == 1, F.col("_name")).otherwise(F.concat(F.col("_name"), F.lit("-"), again.cast("string")))).drop("_name")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key (WIN-09), by one aggregation with partial results."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*(F.col(o).alias(f"_o{i}") for i, o in enumerate(order)), *rest)).alias("_last"))
    return best.select(*keys, *(F.col(f"_last.{c}").alias(c) for c in rest))
