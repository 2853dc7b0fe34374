"""Records of all sources in one shape, and documents out of landed pages and bundles (SRC-03, SRC-10..16)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.functions import text as T
from canonry.functions.dates import china_date, lenient_date

SHAPE = ["system", "record_id", "parent_record_id", "title", "fileno", "org", "day", "status", "plain_text", "local_file", "page_url", "lane"]


def typed_files(files: DataFrame, listed: DataFrame | None, path: str, together: bool = False, limit: int | None = None) -> DataFrame:
    """Files of a typed scan in the order of their paths (SRC-02, SRC-03).

    Those that ``listed`` names if all of them are there, else all; with ``together`` both
    (pages: listed and found). ``limit`` takes the first of them by path.
    """
    out = files.select(path).distinct()
    if listed is not None and together:
        out = out.unionAll(listed.select(path)).distinct()
    elif listed is not None:
        own = listed.select(path).distinct()
        if not own.isEmpty() and own.where(F.col(path).isNotNull()).count() == own.join(out, path, "left_semi").count() == own.count():
            out = own
    out = out.orderBy(path)
    return out if limit is None else out.limit(limit)


def paged_items(pages: DataFrame, page: str, payload: str, keys: dict[str, list[str]]) -> DataFrame:
    """Items of structured pages (SRC-10): a column for each of ``keys``, the first of its names that
    an item's ``domainMetaList[].resultList[]`` has, and ``complete``, whether as many items
    were collected as the pages report."""
    schema = "struct<total: bigint, results: array<struct<domainMetaList: array<struct<resultList: array<struct<key: string, value: string>>>>>>>"
    parsed = pages.select(page, F.from_json(payload, schema).alias("p"))
    items = parsed.select(page, F.col("p.total").alias("_total"), F.posexplode("p.results").alias("_at", "_item"))
    pairs = F.flatten(F.transform("_item.domainMetaList", lambda d: d["resultList"]))
    # The first value of a key counts.
    first = F.aggregate(pairs, F.create_map().cast("map<string, string>"), lambda m, x: F.when(F.map_contains_key(m, x["key"]) | x["key"].isNull(), m).otherwise(F.map_concat(m, F.create_map(x["key"], x["value"]))))
    rows = items.withColumn("_m", first).select(page, F.col("_at").alias("place"), *(F.coalesce(*(F.nullif(F.try_element_at("_m", F.lit(k)), F.lit("")) for k in names)).alias(c) for c, names in keys.items()))
    whole = parsed.agg(F.coalesce(F.sum(F.size("p.results")) == F.max("p.total"), F.lit(False)).alias("complete"))
    return rows.crossJoin(F.broadcast(whole))  # one row


def split_documents(pages: DataFrame, specs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents cut out of pages by a list of (key, document, start, end) (SRC-12, TXT-09); null
    text where a marker isn't there exactly once. The list is configuration, so it is broadcast."""
    return pages.join(F.broadcast(specs), key).select(key, "document", T.slice_between(F.col(text), F.col("start"), F.col("end")).alias("text"))


def bundle(articles: DataFrame, files: DataFrame, account: str, path: str, dropped: list[str]) -> DataFrame:
    """Articles of a bundle with the bytes of their pages (SRC-14), all or none.

    ValueError unless every article has exactly one page and every page one article, and all
    are of one account. ``batch_id`` is the hash of all paths and bytes; ``dropped`` columns
    (counts of readers and the like) are left out; the lane is ``clue``.
    """
    both = articles.select(path).exceptAll(files.select(path)).unionAll(files.select(path).exceptAll(articles.select(path)))
    if not both.isEmpty():
        raise ValueError("articles and pages of the bundle don't match")
    accounts = articles.agg(F.count_distinct(account), F.count_if(F.col(account).isNull())).first()
    if accounts[0] > 1 or accounts[1]:
        raise ValueError("the bundle is of several accounts or of an unknown one")
    hashes = files.select(F.concat_ws(":", path, F.sha2("content", 256)).alias("h"))
    batch = hashes.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("batch_id"))  # a hash per file of one bundle
    return articles.drop(*dropped).join(files, path).crossJoin(F.broadcast(batch)).withColumn("lane", F.lit("clue"))


def tree_hash(files: DataFrame, path: str, content: str) -> DataFrame:
    """One row, ``tree_hash`` of paths and contents (HSH-02), whatever the order; that of nothing is
    the hash of the empty text. Sums of hashes, so a tree of any size is one aggregation."""
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", path, F.sha2(content, 256)), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return files.agg(F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), F.sum(h).cast("string")), 256).alias("tree_hash"))


def per_seed(seeds: DataFrame, landed: DataFrame, keys: list[str], page: str, most: int = 500) -> DataFrame:
    """Landed results of each seed (SRC-11): its rows, or one row without them; ``failed`` where
    they reach ``most`` pages, for then the enumeration was cut."""
    pages = landed.groupBy(*keys).agg(F.max(page).alias("_pages"))
    return seeds.select(*keys).distinct().join(pages, keys, "left").join(landed, keys, "left").withColumn("failed", F.coalesce(F.col("_pages") >= most, F.lit(False))).drop("_pages")


def _shaped(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*(columns.get(c, F.lit(None).cast("date" if c == "day" else "string")).alias(c) for c in SHAPE)).where("record_id is not null").distinct()


def records(law_detail: DataFrame, source_record: DataFrame, writ_document: DataFrame, asset_record: DataFrame, asset_text: DataFrame) -> DataFrame:
    """Records of three sources in one shape (SRC-16).

    Pages' attachments are records of their own, below their page, with its status and day.
    A record whose text is missing or says nothing has the text of its file. Repeated rows
    count once; a record without an id is none.
    """
    law = F.col("lawlist.law")
    laws = _shaped(law_detail, system=F.lit("neris"), record_id=law["secFutrsLawId"], title=law["secFutrsLawName"], fileno=F.nullif(law["fileno"], F.lit("unknown")), org=law["lawPubOrgName"], day=china_date(law["pubDate"]), status=law["lawAthrtyStsCde"], plain_text=law["bodyAftCntnt"], lane=F.lit("rule"))
    day, meta = lenient_date(F.col("metadata.pub_date")), F.col("metadata")
    pages = _shaped(source_record, system=T.canonical_system(F.col("source_system")), record_id=F.col("capture_id"), title=meta["name"], fileno=F.nullif(meta["fileno"], F.lit("unknown")), org=meta["pub_org"], day=day, status=F.lower(F.trim("ingest_status")), plain_text=F.col("content.plain_text"), page_url=F.col("source.page_url"), lane=F.col("material_lane"))
    nested = source_record.select(T.canonical_system(F.col("source_system")).alias("system"), "capture_id", day.alias("day"), F.lower(F.trim("ingest_status")).alias("status"), F.col("metadata.pub_org").alias("org"), F.col("material_lane").alias("lane"), F.explode("assets").alias("a"))
    labels = asset_record.where("asset_id is not null").groupBy("asset_id").agg(F.min("label").alias("label"))
    held = nested.join(labels, F.col("a.asset_id") == F.col("asset_id"), "left")
    files = _shaped(held, system=F.col("system"), record_id=F.col("a.asset_id"), parent_record_id=F.col("capture_id"), title=F.col("label"), org=F.col("org"), day=F.col("day"), status=F.col("status"), local_file=F.col("a.local_file"), page_url=F.col("a.source_url"), lane=F.col("lane"))
    w = F.col("metadata")
    writs = _shaped(writ_document, system=F.lit("writ"), record_id=F.col("writ_id"), title=w["name"], fileno=w["fileno"], org=w["pub_org"], day=china_date(w["dspt_date_ms"]), plain_text=F.col("body"), page_url=F.col("source.page_url"), lane=F.lit("case"))
    every = reduce(DataFrame.unionByName, [laws, pages, files, writs])
    texts = asset_text.groupBy(F.col("local_file").alias("_file")).agg(F.min("plain_text").alias("_text"))
    poor = T.low_signal(F.col("title"), F.col("plain_text"))
    return every.join(texts, F.col("local_file") == F.col("_file"), "left").withColumn("plain_text", F.when(poor & F.col("_text").isNotNull(), F.col("_text")).otherwise(F.col("plain_text"))).select(*SHAPE)


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """path and content of the files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
