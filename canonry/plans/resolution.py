"""Queries of entity resolution: passes, unique overlaps, chains, clauses (AGG-02, JN-05, JN-11..13, TXT-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from canonry.functions import text as T
from canonry.functions.dates import china_date, lenient_date
from canonry.operators import joins, quality, resolve
from canonry.plans.records import _C
from canonry.plans.relations import _FN, _KEYS, _LD, _NT
from canonry.session import table


def _captures(spark, d):
    s = table(spark, d, "source_record")
    return s.select(
        "capture_id", T.canonical_url(F.col("source.page_url")).alias("url"), T.fileno_key(F.col("metadata.fileno")).alias("number"), lenient_date(F.col("metadata.pub_date")).alias("day"),
        T.body_hash(F.col("content.plain_text")).alias("hash"), (-F.coalesce(F.length("content.plain_text"), F.lit(0))).alias("shorter"), F.col("metadata.name").alias("name"),
    ).distinct()


def dedupe_passes(spark, d):
    """Captures merged by number and day, then by body, the longest body kept."""
    return resolve.dedupe_passes(_captures(spark, d), "capture_id", ["shorter"], [["number", "day"], ["hash"]])


def title_overlap_unique(spark, d):
    """Captures that share a title key with exactly one law, number and day not contradicting."""
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), T.fileno_key(F.col("lawlist.law.fileno")).alias("number"), china_date(F.col("lawlist.law.pubDate")).alias("day"), T.title_keys(F.col("lawlist.law.secFutrsLawName")).alias("keys")).distinct()
    rec = _captures(spark, d).select("capture_id", "number", "day", T.title_keys(F.col("name")).alias("keys"))
    return resolve.unique_overlap(rec, law, "capture_id", "law_id", "keys", ["number", "day"])


def quoted_instruments(spark, d):
    """Laws that record names quote in a clause that issues something."""
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), T.normal_title(F.col("lawlist.law.secFutrsLawName")).alias("key")).distinct()
    rec = _captures(spark, d).select(F.col("capture_id").alias("law_id_of"), "name").withColumnRenamed("law_id_of", "capture_id")
    return joins.clause_targets(rec, "capture_id", "name", "发布|印发|废止|公布", law, "key", "law_id", T.normal_title).select("capture_id", "law_id", "title")


def brand_chain(spark, d):
    """Successor edges along a configured chain of brands, found by their cheapest part."""
    chain = spark.createDataFrame([("brands", i, f"Brand#{i}") for i in range(1, 26)], "chain string, position int, p_brand string")
    parts = table(spark, d, "part").select("p_brand", "p_partkey")
    return joins.chain_edges(chain, "chain", "position", ["p_brand"], parts, "p_partkey")


def name_mismatch(spark, d):
    """Laws whose names or numbers differ between the two tables that hold them, by field."""
    a = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.col("lawlist.law.secFutrsLawName").alias("name"), F.col("lawlist.law.fileno").alias("fileno")).distinct()
    b = table(spark, d, "law_document").select("law_id", F.col("metadata.name").alias("name"), F.col("metadata.fileno").alias("fileno")).distinct()
    return quality.mismatches(a, b, "law_id", ["name", "fileno"], "law_equal").groupBy("detail").agg(F.count(F.lit(1)).alias("n"))


def markdown_sizes(spark, d):
    """Rule texts as Markdown: characters, headings and paragraphs."""
    m = table(spark, d, "law_document").select("law_id", T.markdown_body(F.col("full_text")).alias("md")).distinct()
    return m.select("law_id", F.length("md").alias("n"), F.regexp_count("md", F.lit("(?m)^## ")).alias("chapters"), F.regexp_count("md", F.lit("\n\n")).alias("breaks"))


_CAP = f"{_C}, x AS MATERIALIZED (SELECT DISTINCT capture_id, {_FN('fileno')} AS number, {_LD('pub_date')} AS day, CASE WHEN length(regexp_replace(body, '[{T.SPACE}]+', '', 'g')) >= 80 THEN sha256(regexp_replace(body, '[{T.SPACE}]+', '', 'g')) END AS hash, -coalesce(length(body), 0) AS shorter, name FROM c)"
QUERIES = {"dedupe_passes": dedupe_passes, "title_overlap_unique": title_overlap_unique, "quoted_instruments": quoted_instruments, "brand_chain": brand_chain, "law_mismatch": name_mismatch, "markdown_sizes": markdown_sizes}
SQL = {
    "dedupe_passes": f"""WITH {_CAP},
p1 AS MATERIALIZED (SELECT capture_id, first_value(capture_id) OVER (PARTITION BY number, day ORDER BY shorter, capture_id) AS kept FROM x WHERE number IS NOT NULL AND day IS NOT NULL),
m1 AS (SELECT capture_id, kept FROM p1 WHERE capture_id <> kept),
y AS MATERIALIZED (SELECT * FROM x WHERE capture_id NOT IN (SELECT capture_id FROM m1)),
p2 AS MATERIALIZED (SELECT capture_id, first_value(capture_id) OVER (PARTITION BY hash ORDER BY shorter, capture_id) AS kept FROM y WHERE hash IS NOT NULL),
m2 AS (SELECT capture_id, kept FROM p2 WHERE capture_id <> kept)
SELECT m1.capture_id, coalesce(m2.kept, m1.kept) AS kept_id, 0 AS pass FROM m1 LEFT JOIN m2 ON m2.capture_id = m1.kept UNION ALL SELECT capture_id, kept, 1 FROM m2""",
    "title_overlap_unique": f"WITH {_CAP}, a AS MATERIALIZED (SELECT capture_id, number, day, unnest({_KEYS('name')}) AS k FROM x WHERE name IS NOT NULL), l AS MATERIALIZED (SELECT DISTINCT struct_extract(lawlist, 'law') AS w FROM law_detail), b0 AS MATERIALIZED (SELECT w.secFutrsLawId AS law_id, w.secFutrsLawName AS lname, w.fileno AS fno, DATE '1970-01-01' + CAST(floor((w.pubDate + 28800000) / 86400000.0) AS INTEGER) AS d FROM l), b AS MATERIALIZED (SELECT law_id, {_FN('fno')} AS n, d, unnest({_KEYS('lname')}) AS k FROM b0 WHERE lname IS NOT NULL), j AS (SELECT a.capture_id, b.law_id, coalesce(number = n, false) AS strong FROM a JOIN b USING (k) WHERE (number IS NULL OR n IS NULL OR number = n) AND (day IS NULL OR d IS NULL OR day = d)), g AS (SELECT capture_id, min(law_id) FILTER (strong) AS s0, max(law_id) FILTER (strong) AS s1, min(law_id) AS w0, max(law_id) AS w1 FROM j GROUP BY 1) SELECT capture_id, CASE WHEN s0 IS NOT NULL THEN s0 ELSE w0 END AS law_id FROM g WHERE CASE WHEN s0 IS NOT NULL THEN s0 = s1 ELSE w0 = w1 END",
    "markdown_sizes": f"WITH t AS MATERIALIZED (SELECT DISTINCT law_id, full_text FROM law_document), l AS MATERIALIZED (SELECT law_id, full_text IS NULL AS none, list_filter(list_filter(list_transform(string_split(regexp_replace(full_text, '\\r\\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '[{T.SPACE}]+', ' ', 'g'), '^ | $', '', 'g')), lambda x: x <> ''), lambda x: NOT regexp_matches(x, '^[-—– ]*[0-9]{{1,4}}[-—– ]*$')) AS k FROM t), e AS (SELECT row_number() OVER () AS r, law_id, none, k FROM l), x AS (SELECT r, generate_subscripts(k, 1) AS i, unnest(k) AS x FROM e WHERE len(k) > 0), y AS (SELECT r, i, x, lag(x) OVER (PARTITION BY r ORDER BY i) AS p, regexp_matches(x, '^第[一二三四五六七八九十百]+章|^Chapter [0-9]+') AS c, regexp_matches(x, '^第[一二三四五六七八九十百]+条|^Article [0-9]+') AS a FROM x), z AS (SELECT r, length(x) + CASE WHEN c THEN 3 WHEN a THEN 4 ELSE 0 END AS n, c, i > 1 AND (c OR a OR regexp_matches(p, '[。！？；：.!?;:]$') OR regexp_matches(p, '^第[一二三四五六七八九十百]+章|^Chapter [0-9]+')) AS b, i > 1 AND regexp_matches(p, '[A-Za-z0-9,;)]$') AND regexp_matches(x, '^[A-Za-z0-9(]') AS s FROM y), g AS (SELECT r, sum(n + CASE WHEN b THEN 2 WHEN s THEN 1 ELSE 0 END) AS n, count(*) FILTER (c) AS chapters, count(*) FILTER (b) AS breaks FROM z GROUP BY 1) SELECT DISTINCT law_id, CAST(CASE WHEN NOT none THEN coalesce(n, 0) END AS INTEGER) AS n, CASE WHEN NOT none THEN coalesce(chapters, 0) END AS chapters, CASE WHEN NOT none THEN coalesce(breaks, 0) END AS breaks FROM e LEFT JOIN g USING (r)",
    "brand_chain": "WITH k AS (SELECT p_brand, max(p_partkey) AS id FROM part GROUP BY 1), c AS (SELECT i AS position, 'Brand#' || i AS p_brand FROM range(1, 26) t(i)), f AS (SELECT position, id, lag(id) OVER (ORDER BY position) AS older FROM c LEFT JOIN k USING (p_brand)) SELECT 'brands' AS chain, id AS from_id, older AS to_id FROM f WHERE position > 1 AND older IS NOT NULL",
    "quoted_instruments": f"WITH {_C}, l AS MATERIALIZED (SELECT DISTINCT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawName') AS lname FROM law_detail), k AS (SELECT {_NT('lname')} AS key, min(law_id) AS law_id FROM l GROUP BY 1 HAVING min(law_id) = max(law_id)), q AS (SELECT DISTINCT capture_id, unnest(string_split_regex(name, '[。；;！？!?\\n]')) AS clause FROM c), t AS (SELECT DISTINCT capture_id, unnest(regexp_extract_all(clause, '《([^《》]{{4,120}})》', 1)) AS title FROM q WHERE regexp_matches(clause, '发布|印发|废止|公布')) SELECT DISTINCT t.capture_id, k.law_id, t.title FROM t JOIN k ON k.key = {_NT('t.title')} WHERE k.key <> ''",
    "law_mismatch": "WITH a AS MATERIALIZED (SELECT DISTINCT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawName') AS name, struct_extract(struct_extract(lawlist, 'law'), 'fileno') AS fileno FROM law_detail), b AS MATERIALIZED (SELECT DISTINCT law_id, struct_extract(metadata, 'name') AS name, struct_extract(metadata, 'fileno') AS fileno FROM law_document), j AS (SELECT a.law_id AS ka, b.law_id AS kb, a.name IS DISTINCT FROM b.name AS n, a.fileno IS DISTINCT FROM b.fileno AS f FROM a FULL JOIN b ON a.law_id = b.law_id), w AS (SELECT CASE WHEN ka IS NULL THEN 'extra' WHEN kb IS NULL THEN 'missing' ELSE concat_ws(',', CASE WHEN n THEN 'name' END, CASE WHEN f THEN 'fileno' END) END AS detail FROM j) SELECT detail, count(*) AS n FROM w WHERE detail <> '' GROUP BY 1",
}
