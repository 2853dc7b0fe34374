"""Sources: landed rows of several shapes as DataFrames (SRC)."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from canonry.functions.text import canonical_url


def json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON document per file (SRC-01), with its path; no schema is inferred."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path).withColumn("path", F.col("_metadata.file_path"))


def json_lines(spark: SparkSession, path: str, schema: StructType | str, key: str | None = None, order: str | None = None) -> DataFrame:
    """An event log (SRC-04); corrupt lines are left out. With a key the last line of each."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    if key is None:
        return rows
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max(F.struct(F.col(order).alias("_o"), *rest)).alias("_x")).select(key, *(F.col(f"_x.{c}").alias(c) for c in rest))


def manifest_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Files that a manifest lists (SRC-02); all files if it lists none or one that is absent."""
    listed = manifest.select("file").distinct()
    broken = listed.join(files, "file", "left_anti").agg(F.count(F.lit(1)).alias("lost")).crossJoin(listed.agg(F.count(F.lit(1)).alias("listed")))  # a row each
    usable = files.join(listed.withColumn("_in", F.lit(True)), "file", "left").crossJoin(F.broadcast(broken))
    return usable.where((F.col("lost") > 0) | (F.col("listed") == 0) | F.col("_in")).drop("_in", "lost", "listed")


def csv_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A headed CSV in UTF-8, with or without a byte order mark (SRC-17)."""
    return spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").option("multiLine", True).option("escape", '"').csv(path)


def decode(data: bytes) -> str:
    """Text of bytes: UTF-8 with or without mark, then GB 18030, then UTF-8 with losses."""
    for codec in ("utf-8-sig", "gb18030"):
        try:
            return data.decode(codec)
        except UnicodeDecodeError:
            pass
    return data.decode("utf-8", "replace")


def _sheet_text(data: bytes) -> str:
    """Cells of a workbook row by row, by the standard library alone."""
    tag = lambda e: e.tag.rpartition("}")[2]
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter() if tag(t) == "t") for si in ET.fromstring(z.read("xl/sharedStrings.xml")) if tag(si) == "si"]
        out = []
        for name in sorted(n for n in names if n.startswith("xl/worksheets/") and n.endswith(".xml")):
            for row in (e for e in ET.fromstring(z.read(name)).iter() if tag(e) == "row"):
                cells = []
                for c in (e for e in row if tag(e) == "c"):
                    text = "".join(t.text or "" for t in c.iter() if tag(t) in ("v", "t"))
                    cells.append(shared[int(text)] if c.get("t") == "s" and text.isdigit() and int(text) < len(shared) else text)
                if any(cells):
                    out.append("\t".join(cells))
        return "\n".join(out)


def _word_text(data: bytes) -> str:
    tag = lambda e: e.tag.rpartition("}")[2]
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ET.fromstring(z.read("word/document.xml"))
    return "\n".join(t for p in root.iter() if tag(p) == "p" and (t := "".join(x.text or "" for x in p.iter() if tag(x) == "t").strip()))


def file_kind(data: bytes, name: str = "") -> str:
    """Kind of a file by its first bytes, then by its name (SNF-01)."""
    for magic, kind in ((b"\x89PNG", "png"), (b"\xff\xd8\xff", "jpg"), (b"GIF8", "gif"), (b"%PDF", "pdf"), (b"{\\rtf", "rtf"), (b"\xd0\xcf\x11\xe0", "doc")):
        if data.startswith(magic):
            return kind
    if data.startswith(b"PK\x03\x04"):
        try:
            names = zipfile.ZipFile(io.BytesIO(data)).namelist()
        except zipfile.BadZipFile:
            return "zip"
        return "docx" if "word/document.xml" in names else "xlsx" if any(n.startswith("xl/") for n in names) else "zip"
    return name.rpartition(".")[2].lower() if "." in name else "txt"


def asset_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, kind, size, text and failure of binary files (SRC-15).

    What can't be read has a null text and says why: ``no reader`` for kinds without one,
    else the error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for p, data in zip(batch.path, batch.content, strict=True):
                kind, text, failure = file_kind(bytes(data), p), None, None
                try:
                    read = {"xlsx": _sheet_text, "docx": _word_text, "txt": decode, "html": decode, "htm": decode, "csv": decode, "json": decode}.get(kind)
                    text, failure = (read(bytes(data)), None) if read else (None, "no reader")
                except Exception as e:  # a broken file isn't an error of the scan, but it is told
                    failure = f"{type(e).__name__}: {e}"
                rows.append((p, kind, len(data), text, failure))
            yield pd.DataFrame(rows, columns=["path", "kind", "size", "text", "failure"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(run, "path string, kind string, size bigint, text string, failure string")


def registry(endpoints: DataFrame, overlay: DataFrame | None = None) -> DataFrame:
    """Endpoints by address with their profiles (SRC-18); an overlay row replaces the base row of its id."""
    rows = endpoints if overlay is None else endpoints.join(overlay.select("endpoint_id").distinct(), "endpoint_id", "left_anti").unionByName(overlay, allowMissingColumns=True)
    grouped = rows.groupBy(canonical_url(F.col("url")).alias("url")).agg(
        F.min("endpoint_id").alias("endpoint_id"), F.array_sort(F.collect_set("profile")).alias("profiles"), F.min("scope_mode").alias("scope_mode"), F.max("scope_mode").alias("_other")
    )
    return grouped.withColumn("conflict", F.coalesce(F.col("scope_mode") != F.col("_other"), F.lit(False))).drop("_other")
