"""Sinks: tables, reports and atomic publication (SNK)."""

from __future__ import annotations

import html
import json
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _point(spark, root: str, name: str, target: str) -> None:
    """Replace the pointer file of ``name`` in one rename; the one before is kept as PREVIOUS."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(conf)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(root).toUri() if path(root).toUri().getScheme() else fs.getUri(), conf)
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE

    def put(file: str, text: str) -> None:
        fresh = path(f"{root}/{name}/{file}.{uuid.uuid4().hex}")
        out = fs.create(fresh)
        out.write(bytearray(text.encode()))
        out.close()
        context.rename(fresh, path(f"{root}/{name}/{file}"), overwrite)

    if (before := current(spark, root, name)) is not None:
        put("PREVIOUS", before)
    put("CURRENT", target)


def current(spark, root: str, name: str, file: str = "CURRENT") -> str | None:
    """What the pointer of ``name`` says, null if there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{file}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return "\n".join(r[0] for r in spark.read.text(f"{root}/{name}/{file}").collect()) if fs.exists(path) else None  # a line per table


def publish(df: DataFrame, root: str, name: str, issues: DataFrame | None = None) -> str:
    """Write a new version of a table and point ``name`` at it (SNK-01, SNK-05).

    With issues nothing is published. Readers follow the pointer file, which is replaced in
    one rename, so they see the old version or the new one, never a part.
    """
    if issues is not None and not issues.isEmpty():
        raise ValueError(f"{name} has issues; the version in place stays")
    version = f"{root}/{name}/v-{uuid.uuid4().hex}"
    df.write.parquet(version)
    _point(df.sparkSession, root, name, version)
    return version


def published(spark, root: str, name: str) -> DataFrame:
    """The current version of a published table."""
    return spark.read.parquet(current(spark, root, name))


def publish_bundle(tables: dict[str, DataFrame], root: str, name: str, check=None) -> str:
    """Publish several tables at once (SNK-03, SNK-13): all are written, then ``check`` may look at
    them and raise, then one pointer moves. A failure before that leaves what was published
    as it is, and the unfinished version without a reader."""
    version = f"{root}/{name}/v-{uuid.uuid4().hex}"
    spark = next(iter(tables.values())).sparkSession
    for t, df in tables.items():
        df.write.parquet(f"{version}/{t}")
    if check is not None:
        check({t: spark.read.parquet(f"{version}/{t}") for t in tables})
    _point(spark, root, name, version)
    return version


def bundle_table(spark, root: str, name: str, table: str) -> DataFrame:
    """A table of the current version of a bundle."""
    return spark.read.parquet(f"{current(spark, root, name)}/{table}")


def roll_back(spark, root: str, name: str) -> str:
    """Point at the version before the current one again (SNK-04); ValueError if there is none."""
    before = current(spark, root, name, "PREVIOUS")
    if before is None:
        raise ValueError(f"{name} has no version before the current one")
    _point(spark, root, name, before)
    return before


def digest(changes: DataFrame, run: str, key: str, change: str, title: str) -> dict[str, str]:
    """Digest of a run's changes as JSON, Markdown and HTML (SNK-10): how many of each kind, and a
    table of them. The changes of one run are a report for readers, so they are collected."""
    rows = [tuple(r) for r in changes.select(change, key, F.coalesce(title, F.lit(""))).orderBy(change, key).collect()]
    counts: dict[str, int] = {}
    for c, _, _ in rows:
        counts[c] = counts.get(c, 0) + 1
    cell = lambda x: str(x).replace("|", "\\|").replace("\n", " ")
    line = lambda r, tag: "<tr>" + "".join(f"<{tag}>{html.escape(str(x))}</{tag}>" for x in r) + "</tr>"
    md = [f"# {run}", "", *(f"- {c}: {n}" for c, n in sorted(counts.items())), "", "| change | id | title |", "| --- | --- | --- |", *("| " + " | ".join(map(cell, r)) + " |" for r in rows)]
    page = f"<h1>{html.escape(run)}</h1><ul>" + "".join(f"<li>{html.escape(c)}: {n}</li>" for c, n in sorted(counts.items())) + "</ul><table>" + line(("change", "id", "title"), "th") + "".join(line(r, "td") for r in rows) + "</table>"
    return {"json": json.dumps({"run": run, "counts": counts, "changes": [dict(zip(("change", "id", "title"), r, strict=True)) for r in rows]}, ensure_ascii=False), "markdown": "\n".join(md) + "\n", "html": page}


class Run:
    """Telemetry of a run (SNK-11): counters by name and labels, events and failures, written as
    JSON lines. Rows are counted while they are written, by observation, not by a job of their own."""

    def __init__(self, spark, run_id: str, path: str) -> None:
        self.spark, self.run_id, self.path, self.counters, self.events, self._seen = spark, run_id, path, {}, [], []

    def count(self, name: str, n: int = 1, **labels: str) -> None:
        key = name + ("{" + ",".join(f"{k}={v}" for k, v in sorted(labels.items())) + "}" if labels else "")
        self.counters[key] = self.counters.get(key, 0) + n

    def event(self, name: str, **fields: str) -> None:
        self.events.append((len(self.events), name, json.dumps(fields, ensure_ascii=False, sort_keys=True)))

    def observed(self, df: DataFrame, name: str, **labels: str) -> DataFrame:
        o = Observation(f"{name}-{uuid.uuid4().hex}")
        self._seen.append((o, name, labels))
        return df.observe(o, F.count(F.lit(1)).alias("rows"))

    def close(self, ok: bool = True) -> None:
        for o, name, labels in self._seen:
            self.count(name, o.get["rows"], **labels)
        rows = [(self.run_id, "event", n, name, fields, None) for n, name, fields in self.events]
        rows += [(self.run_id, "counter", 0, k, None, v) for k, v in sorted(self.counters.items())]
        rows.append((self.run_id, "run", 0, "complete" if ok else "failed", None, None))
        self.spark.createDataFrame(rows, "run_id string, kind string, place int, name string, fields string, value bigint").coalesce(1).write.mode("append").json(self.path)


def markdown_library(df: DataFrame, root: str, buckets: list[str], name: str, text: str) -> None:
    """Markdown files' texts below folders of the buckets (SNK-08), a row per file, null buckets under ``unknown``."""
    safe = lambda c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("unknown")), r"[/\\\\:*?\"<>|\\s]+", "_")
    df.select(*(safe(b).alias(b) for b in buckets), name, text).write.mode("overwrite").partitionBy(*buckets).parquet(root)


def append_events(df: DataFrame, path: str) -> None:
    """Append rows to a log of JSON lines (SNK-02)."""
    df.write.mode("append").json(path)


def csv_report(df: DataFrame, path: str) -> None:
    """A headed CSV (SNK-06): arrays joined by ``;``, structs and maps as JSON."""
    flat = df.select(*(F.array_join(c, ";").alias(c) if t.startswith("array<string") else F.to_json(c).alias(c) if t.startswith(("struct", "map", "array")) else F.col(c) for c, t in df.dtypes))
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def markdown(df: DataFrame, title: str, fields: list[str], body: str) -> DataFrame:
    """``df`` with a ``markdown`` column (SNK-07): front matter, heading, table of fields, body."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    cell = lambda c: F.replace(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"\s*\n\s*", " "), F.lit("|"), F.lit("\\|"))
    front = F.concat_ws("\n", F.lit("---"), *(F.concat(F.lit(f"{f}: "), quoted(f)) for f in [title, *fields]), F.lit("---"))
    rows = F.concat_ws("\n", F.lit("| field | value |\n| --- | --- |"), *(F.concat(F.lit(f"| {f} | "), cell(f), F.lit(" |")) for f in fields))
    return df.withColumn("markdown", F.concat_ws("\n\n", front, F.concat(F.lit("# "), cell(title)), rows, F.coalesce(F.col(body), F.lit(""))))
