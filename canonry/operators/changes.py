"""Changes between runs: snapshot differences and the removal state of keys (STR-01, STR-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Complete runs in a row that miss a key before it counts as removed.
MISSES = 2


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, content: str, fields: str) -> DataFrame:
    """(key, change): new, removed, content_changed or metadata_changed; unchanged keys give none."""
    b = before.select(key, F.col(content).alias("_c0"), F.col(fields).alias("_m0"), F.lit(1).alias("_b"))
    a = after.select(key, F.col(content).alias("_c1"), F.col(fields).alias("_m1"), F.lit(1).alias("_a"))
    change = (
        F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "removed").when(~F.col("_c0").eqNullSafe(F.col("_c1")), "content_changed").when(~F.col("_m0").eqNullSafe(F.col("_m1")), "metadata_changed")
    )
    return b.join(a, key, "full_outer").select(key, change.alias("change")).where("change is not null")


def removal_events(seen: DataFrame, runs: DataFrame, key: str, run: str) -> DataFrame:
    """(key, run, event) over complete runs: ``removed`` at the second miss in a row,
    ``restored`` when seen again after it.

    ``seen`` has a row per key and run, ``runs`` the complete runs. Only seen rows are
    stored and sorted; misses follow from the numbers of the runs on both sides of a gap,
    so absent keys need no rows.
    """
    numbered = runs.select(run).distinct().withColumn("_n", F.row_number().over(W.orderBy(run)))  # a row per run
    last = numbered.agg(F.max("_n").alias("_last"))
    w = W.partitionBy(key).orderBy("_n")
    own = seen.select(key, run).distinct().join(numbered, run)
    gaps = own.withColumn("_next", F.lead("_n").over(w)).crossJoin(F.broadcast(last))  # one row
    gone = gaps.where(F.coalesce("_next", F.col("_last") + 1) - F.col("_n") > MISSES)
    removed = gone.select(key, (F.col("_n") + MISSES).alias("_n"), F.lit("removed").alias("event"))
    back = gone.where("_next is not null").select(key, F.col("_next").alias("_n"), F.lit("restored").alias("event"))
    return removed.unionAll(back).join(numbered, "_n").select(key, run, "event")
