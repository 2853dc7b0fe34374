"""State carried from run to run: what is kept, resumed, cached, accumulated and queued (STR, JN-20..26, AGG-22)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last_good(attempts: DataFrame, key: str, complete: Column, order: list[str]) -> DataFrame:
    """One attempt per key (STR-02): the last complete one, else the last; ``is_complete`` says which.

    So an incomplete attempt never replaces a complete record. One aggregation; a null
    completeness is incomplete, a null key belongs to no record.
    """
    rest = [c for c in attempts.columns if c != key]
    rank = F.struct(F.coalesce(complete, F.lit(False)).alias("_ok"), *(F.col(o).alias(f"_o{i}") for i, o in enumerate(order)), *(F.col(c) for c in rest))
    best = attempts.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(rank).alias("_x"))
    return best.select(key, *(F.col(f"_x.{c}").alias(c) for c in rest), F.col("_x._ok").alias("is_complete"))


def resumed(todo: DataFrame, done: DataFrame, keys: list[str], now: dict[str, str], before: dict[str, str]) -> DataFrame:
    """What of ``todo`` is still to do (STR-04, FIL-11): its keys aren't among those ``done``.

    Refused with ValueError where the run's fingerprint (registry, code, mode, list of
    endpoints ...) isn't the one that the work done was done under.
    """
    changed = sorted(k for k in {*now, *before} if now.get(k) != before.get(k))
    if changed:
        raise ValueError(f"can't resume, changed since: {', '.join(changed)}")
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def uncached(queries: DataFrame, finished: DataFrame, outputs: DataFrame, fingerprint: str, output: str) -> DataFrame:
    """Queries to run (STR-05): their fingerprint isn't finished, or an output of it is gone.

    ``finished`` has a row per fingerprint and output. A finished query without outputs
    (null) stays cached.
    """
    there = outputs.select(F.col(output).alias("_there")).distinct()
    gone = finished.where(F.col(output).isNotNull()).join(there, F.col(output) == F.col("_there"), "left_anti").select(fingerprint).distinct()
    usable = finished.select(fingerprint).distinct().join(gone, fingerprint, "left_anti")
    return queries.join(usable, fingerprint, "left_anti")


def accumulated(evidence: DataFrame, key: str, order: list[str], sets: list[str], owner: str) -> DataFrame:
    """One row per key (STR-07): the owner seen first, and of each of ``sets`` the values of all
    runs, sorted, each once. Values are made distinct before they gather."""
    first = evidence.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order, owner)).alias("_f")).select(key, F.col(f"_f.{owner}").alias(owner))
    for c in sets:
        held = evidence.select(key, c).dropna().distinct().groupBy(key).agg(F.array_sort(F.collect_list(c)).alias(c))
        first = first.join(held, key, "left").withColumn(c, F.coalesce(c, F.array().cast(held.schema[c].dataType)))
    return first


def run_status(parts: DataFrame, run: str, steps: list[Column], published: Column) -> DataFrame:
    """One row per run (STR-08): how many parts, how many of them complete, whether all are, and
    the state of its publication: ``published``, ``quarantined`` or, where nothing asks for
    it (null), ``n/a``. A part is complete if all its steps are; null is no."""
    done = reduce(lambda a, b: a & b, (F.coalesce(s, F.lit(False)) for s in steps))
    g = parts.groupBy(run).agg(F.count(F.lit(1)).alias("parts"), F.count_if(done).alias("complete_parts"), F.bool_and(published).alias("_p"))
    whole = F.col("parts") == F.col("complete_parts")
    status = F.when(F.col("_p").isNull(), "n/a").when(whole & F.col("_p"), "published").otherwise("quarantined")
    return g.select(run, "parts", "complete_parts", whole.alias("is_complete"), status.alias("publish_status"))


def latest_complete(runs: DataFrame, run: str, at: str, complete: Column, keys: list[str] | None = None) -> DataFrame:
    """The last complete run (AGG-22), of each of ``keys`` or of all: keys, run, at. None if none is."""
    g = runs.where(F.coalesce(complete, F.lit(False))).groupBy(*(keys or [])).agg(F.max(F.struct(at, run)).alias("_x"))
    return g.where("_x is not null").select(*(keys or []), F.col(f"_x.{run}").alias(run), F.col(f"_x.{at}").alias(at))


def queued(queue: DataFrame, found: DataFrame, decided: list[tuple[DataFrame, str]], key: str, at: str) -> DataFrame:
    """The review queue after a run (STR-09, JN-24): keys of the queue or found now, without those
    decided, with the first and the last time they were queued.

    ``queue`` has key, first_queued_at, last_queued_at; ``found`` key, ``at`` and the columns
    that decisions refer to; ``decided`` tables with the name of the column they close. What
    isn't found any more stays queued.
    """
    for rows, column in decided:
        found = found.join(rows.select(column).distinct(), column, "left_anti")
        if column in queue.columns:
            queue = queue.join(rows.select(column).distinct(), column, "left_anti")
    now = found.groupBy(key).agg(F.min(at).alias("first_queued_at"), F.max(at).alias("last_queued_at"))
    both = queue.select(key, "first_queued_at", "last_queued_at").unionByName(now)
    return both.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("first_queued_at").alias("first_queued_at"), F.max("last_queued_at").alias("last_queued_at"))


def carried(rows: DataFrame, key: str, priors: list[DataFrame], columns: list[str], overrides: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``columns`` of the first prior state that has them (JN-20), and, where the
    key is in ``overrides``, all of them from there, nulls included.

    Keys are unique in every state; ``state_of`` is the number of the state used, -1 for the
    overrides, null for none.
    """
    out = rows
    for i, p in enumerate(priors):
        out = out.join(p.select(F.col(key).alias(f"_k{i}"), *(F.col(c).alias(f"_{c}{i}") for c in columns)), F.col(key) == F.col(f"_k{i}"), "left")
    of = F.coalesce(*(F.when(F.col(f"_k{i}").isNotNull(), F.lit(i)) for i in range(len(priors))))
    values = {c: F.coalesce(*(F.col(f"_{c}{i}") for i in range(len(priors)))) for c in columns}
    if overrides is not None:
        out = out.join(overrides.select(F.col(key).alias("_ko"), *(F.col(c).alias(f"_{c}o") for c in columns)), F.col(key) == F.col("_ko"), "left")
        hit = F.col("_ko").isNotNull()
        of = F.when(hit, F.lit(-1)).otherwise(of)
        values = {c: F.when(hit, F.col(f"_{c}o")).otherwise(v) for c, v in values.items()}
    return out.select(*rows.columns, *(v.alias(c) for c, v in values.items()), of.alias("state_of"))


def matched_either(left: DataFrame, right: DataFrame, left_id: str, right_id: str, keys: list[str]) -> DataFrame:
    """(left_id, right_id, by): pairs equal in any of the keys, with those they are equal in, in
    order (JN-23). One equi-join per key and a union, not a join with OR; nulls match nothing."""
    each = [
        left.select(left_id, F.col(k).alias("_k")).where("_k is not null").join(right.select(right_id, F.col(k).alias("_k")), "_k").select(left_id, right_id, F.lit(i).alias("_i"), F.lit(k).alias("by")).distinct()
        for i, k in enumerate(keys)
    ]
    both = reduce(DataFrame.unionAll, each)
    return both.groupBy(left_id, right_id).agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("_i", "by"))), lambda x: x["by"]), ",").alias("by"))


def preferred(rows: DataFrame, key: str, choices: list[tuple[str, DataFrame, str, Column]]) -> DataFrame:
    """``rows`` with the first usable value by ``choices`` (JN-25, JN-26): (name, table, column,
    usable), and the name of the choice; null where none has one.

    A table's keys may repeat; the least usable value of a key counts.
    """
    out = rows
    for i, (_, t, column, usable) in enumerate(choices):
        held = t.where(usable & F.col(column).isNotNull()).groupBy(F.col(key).alias(f"_k{i}")).agg(F.min(column).alias(f"_v{i}"))
        out = out.join(held, F.col(key) == F.col(f"_k{i}"), "left")
    n = range(len(choices))
    origin = F.coalesce(*(F.when(F.col(f"_v{i}").isNotNull(), F.lit(choices[i][0])) for i in n))
    return out.select(*rows.columns, F.coalesce(*(F.col(f"_v{i}") for i in n)).alias("value"), origin.alias("origin"))
