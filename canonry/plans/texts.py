"""Queries of the text, number, date and array functions over whole columns (FIL-10..16, TXT-11..20, DAT-03/04, NUM-02, ARR, WIN-03..08)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canonry.functions import dates
from canonry.functions import text as T
from canonry.operators import windows
from canonry.plans.relations import _LD, _NT
from canonry.session import table


def low_signal(spark, d):
    """FIL-10: captures whose text says nothing beyond its title."""
    s = table(spark, d, "source_record").select("capture_id", F.col("metadata.name").alias("title"), F.col("content.plain_text").alias("body")).distinct()
    return s.select("capture_id", T.low_signal(F.col("title"), F.col("body")).alias("low_signal"))


def resolved_links(spark, d):
    """FIL-16: addresses of assets on their pages, also as relative ones."""
    s = table(spark, d, "source_record").select("capture_id", F.col("source.page_url").alias("base"), F.posexplode("assets").alias("place", "a"))
    u = F.col("a.source_url")
    bare = F.regexp_replace(u, "^https?:", "")
    path = F.regexp_replace(u, "^https?://[^/]+", "")
    each = F.explode(F.array(F.struct(F.lit("whole").alias("kind"), u.alias("href")), F.struct(F.lit("scheme").alias("kind"), bare.alias("href")), F.struct(F.lit("path").alias("kind"), path.alias("href")), F.struct(F.lit("beside").alias("kind"), F.regexp_extract(u, "([^/]+)$", 1).alias("href"))))
    return s.select("capture_id", "place", "base", each.alias("x")).select("capture_id", "place", "x.kind", T.resolved_link(F.col("x.href"), F.col("base")).alias("url")).distinct()


def full_texts(spark, d):
    """TXT-11: full texts composed of name, opening, entries with their items, and closing."""
    law = F.col("lawlist.law")
    entry = lambda e: F.concat(F.array(e["title"], e["cntnt"]), F.flatten(F.transform(F.coalesce(e["itemList"], F.array().cast("array<struct<secFutrsLawEntryId:string,secFutrsLawEntryCde:string,title:string,cntnt:string>>")), lambda i: F.array(i["title"], i["cntnt"]))))
    parts = F.concat(F.array(law["secFutrsLawName"], law["bodyAgoCntnt"]), F.coalesce(F.flatten(F.transform("lawlist.lawEntryVOs", entry)), F.array().cast("array<string>")), F.array(law["bodyAftCntnt"]))
    t = table(spark, d, "law_detail").select(law["secFutrsLawId"].alias("law_id"), T.composed_text(parts).alias("t")).distinct()
    return t.select("law_id", F.length("t").alias("n"), F.sha2("t", 256).alias("text_hash"))


def markdown_bodies(spark, d):
    """TXT-15: bodies read back from exported Markdown; only trimmed."""
    doc = table(spark, d, "documents").where(~T.blank(F.col("text")))
    clean = T.clean_lines(F.regexp_replace("text", "[#|-]", " "))
    md = F.concat(F.lit("---\nid: "), F.col("doc_id").cast("string"), F.lit("\n---\n\n# "), F.coalesce("title", F.lit("x")), F.lit("\n\n| k | v |\n| --- | --- |\n| a | b |\n\n"), clean, F.lit("\n\n## 来源\n\n- x\n"))
    return doc.select("doc_id", F.sha2(T.markdown_main(md), 256).alias("body_hash"))


def institutions_named(spark, d):
    """TXT-19: institutions named in the titles of decisions."""
    w = table(spark, d, "writ_document").select("writ_id", F.col("metadata.name").alias("name")).distinct()
    return w.select("writ_id", F.explode(T.institutions(F.regexp_replace("name", "^关于对?", ""))).alias("institution"))


def published_days(spark, d):
    """DAT-04: publication dates of documents, also from packed days in addresses made of them."""
    day = dates.lenient_date(F.col("pub_date"))
    url = F.concat(F.lit("https://x.example/t"), F.date_format(day, "yyyyMMdd"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".html"))
    doc = table(spark, d, "documents").select("doc_id", "pub_date", F.coalesce(url, F.col("page_url")).alias("url"))
    return doc.select("doc_id", dates.published(F.col("pub_date"), F.col("url")).alias("published"))


def effective_from(spark, d):
    """DAT-03: dates from which laws hold: by a clause of their closing text, else, as all hold from their publication, by version or publication."""
    law = table(spark, d, "law_detail").select("lawlist.law.*").distinct()
    pub, stated = dates.china_date(F.col("pubDate")), dates.china_date(F.col("efctvDate"))
    text = F.concat(F.coalesce(T.compact(F.col("bodyAftCntnt")), F.lit("")), F.lit("本办法自公布之日起施行。"))
    return law.select(F.col("secFutrsLawId").alias("law_id"), dates.effective(text, stated, F.col("secFutrsLawVersion"), pub).alias("effective")).distinct()


def chinese_numbers(spark, d):
    """NUM-02: line numbers times days of shipping in Chinese."""
    n = F.col("l_linenumber") * F.dayofmonth(F.col("l_shipdate").cast("date"))
    return table(spark, d, "lineitem").select(n.cast("int").alias("n")).distinct().select("n", T.chinese_number(F.col("n")).alias("zh"))


def ordered_values(spark, d):
    """ARR-01, SET-05: what each capture states, in order, each once."""
    s = table(spark, d, "source_record").select("capture_id", F.array("metadata.source_category", "web_category_leaf", "material_lane", "page_role", "metadata.source_category").alias("v")).distinct()
    return s.select("capture_id", F.array_join(T.unique_present(F.col("v")), "|").alias("v"))


def provenance(spark, d):
    """WIN-07: the best category of each record: stated by its metadata, else by the site's leaf, else its lane."""
    s = table(spark, d, "source_record").where("source_record_id is not null").select("source_record_id", "capture_id", F.posexplode(F.array("metadata.source_category", "web_category_leaf", "material_lane")).alias("rank", "category")).where("category is not null and category <> 'unknown'")
    return s.groupBy("source_record_id").agg(F.min(F.struct("rank", "capture_id", "category")).alias("x")).select("source_record_id", F.col("x.rank").alias("rank"), F.col("x.category").alias("category"))


def table_ids(spark, d):
    """WIN-08: items of entries, numbered through each law as ``table_0001``."""
    e = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.filter(F.flatten(F.transform("lawlist.lawEntryVOs", lambda x: F.coalesce(x["itemList"], F.array().cast("array<struct<secFutrsLawEntryId:string,secFutrsLawEntryCde:string,title:string,cntnt:string>>")))), lambda i: i["secFutrsLawEntryId"].isNotNull()).alias("items")).distinct()
    return e.select("law_id", F.posexplode("items").alias("i", "x")).select("law_id", F.concat(F.lit("table_"), F.lpad((F.col("i") + 1).cast("string"), 4, "0")).alias("table_id"), F.col("x.secFutrsLawEntryId").alias("item_id"))


def kept_members(spark, d):
    """WIN-03: the entity's capture to keep: of a primary system first, then the longest body, the most complete, the least id."""
    m = table(spark, d, "source_map").select("source_system", "record_id", "entity_id").distinct()
    trust = table(spark, d, "source_trust").select(T.canonical_system(F.col("source_system")).alias("source_system"), "trust_rank")
    known = lambda c: F.coalesce(F.nullif(F.trim(F.col(f"metadata.{c}")), F.lit("unknown")), F.lit("")) != ""
    s = table(spark, d, "source_record").select("capture_id", T.canonical_system(F.col("source_system")).alias("source_system"), F.col("source_record_id").alias("record_id"), F.coalesce(F.length("content.plain_text"), F.lit(0)).alias("n"), sum((known(c).cast("int") for c in ("fileno", "pub_date", "pub_org")), known("name").cast("int")).alias("score")).distinct()
    j = s.join(m, ["source_system", "record_id"]).join(trust, "source_system", "left")
    order = F.struct((F.coalesce("trust_rank", F.lit(99)) > 3).alias("other"), (-F.col("n")).alias("n"), (-F.col("score")).alias("score"), "capture_id")
    return j.groupBy("entity_id").agg(F.count_distinct("capture_id").alias("members"), F.min(order).alias("x")).select("entity_id", "members", F.col("x.capture_id").alias("capture_id"))


def page_number_lines(spark, d):
    """WIN-04: lines of scanned texts that are page numbers: runs up by one from at most 9 (a file may begin within a document), of three or more, or of two from the first line."""
    t = table(spark, d, "asset_text").where("local_file is not null").select("local_file", F.posexplode(F.split("plain_text", "\n")).alias("line_no", "line"))
    n = t.where(F.col("line").rlike(r"^[-—–·~\f\s]*[0-9]{1,4}[-—–·~\s]*$")).select("local_file", "line_no", F.regexp_extract("line", "[0-9]+", 0).cast("int").alias("value"))
    w = W.partitionBy("local_file").orderBy("line_no")
    fresh = F.coalesce((F.col("value") != F.lag("value").over(w) + 1).cast("int"), F.lit(1))
    runs = n.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(w.rowsBetween(W.unboundedPreceding, 0)))
    g = windows.islands(n, ["local_file"], "line_no", "value").where("first <= 9 and (length >= 3 or (length = 2 and begin = 0))").select(F.col("local_file").alias("_f"), "begin")
    starts = runs.withColumn("begin", F.min("line_no").over(W.partitionBy("local_file", "run")))
    return starts.join(g.withColumnRenamed("begin", "_b"), (F.col("local_file") == F.col("_f")) & (F.col("begin") == F.col("_b"))).select("local_file", "line_no", "value")


def projected(spark, d):
    """FIL-12: one row of metadata per law, the first value that says something of both tables."""
    a = table(spark, d, "law_detail").select("lawlist.law.*").where("secFutrsLawId is not null").groupBy(F.col("secFutrsLawId").alias("law_id")).agg(F.min(F.nullif(F.trim("secFutrsLawName"), F.lit(""))).alias("name"), F.min(F.nullif(F.nullif(F.trim("fileno"), F.lit("")), F.lit("unknown"))).alias("fileno"), F.min(F.nullif(F.trim("lawPubOrgName"), F.lit(""))).alias("org"))
    b = table(spark, d, "law_document").groupBy("law_id").agg(F.min("metadata.name").alias("n2"), F.min("metadata.fileno").alias("f2"), F.min("metadata.pub_org").alias("o2"))
    return a.join(b, "law_id", "left").select("law_id", F.coalesce("name", "n2").alias("name"), F.coalesce("fileno", F.nullif("f2", F.lit("unknown"))).alias("fileno"), F.coalesce("org", "o2").alias("org"))


_WS = T.SPACE
_P = T.PUNCT.replace("'", "''")
_BARE = lambda c: f"coalesce(regexp_replace({c}, '[{_P}]+', '', 'g'), '')"
_TRIM = lambda c: f"regexp_replace({c}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"
_SEE, _SEC = T.SEE_ATTACHMENT, T.SECTION
_CN = "(DATE '1970-01-01' + CAST(floor((@ + 28800000) / 86400000.0) AS INTEGER))"
QUERIES = {
    "low_signal": low_signal, "resolved_links": resolved_links, "full_texts": full_texts, "markdown_bodies": markdown_bodies, "institutions_named": institutions_named, "published_days": published_days,
    "effective_from": effective_from, "chinese_numbers": chinese_numbers, "ordered_values": ordered_values, "provenance": provenance, "table_ids": table_ids, "kept_members": kept_members,
    "page_number_lines": page_number_lines, "projected_metadata": projected,
}
SQL = {
    "low_signal": f"WITH s AS MATERIALIZED (SELECT DISTINCT capture_id, {_BARE('struct_extract(metadata, ' + chr(39) + 'name' + chr(39) + ')')} AS t, {_BARE('struct_extract(content, ' + chr(39) + 'plain_text' + chr(39) + ')')} AS x, struct_extract(content, 'plain_text') AS raw, struct_extract(metadata, 'name') AS name FROM source_record), r AS (SELECT *, regexp_replace(regexp_replace(CASE WHEN t = '' THEN x ELSE replace(x, t, '') END, '{_SEE}', '', 'g'), '{_SEC}', '', 'g') AS rest FROM s) SELECT capture_id, x = '' OR (t <> '' AND rest = '') OR (regexp_matches(x, '{_SEE}') AND length(rest) <= 30) OR (t <> '' AND contains(x, t) AND length(rest) <= 8) AS low_signal FROM r",
    "resolved_links": "WITH u AS (SELECT capture_id, struct_extract(source, 'page_url') AS base, generate_subscripts(assets, 1) - 1 AS place, unnest(assets) AS a FROM source_record), x AS MATERIALIZED (SELECT DISTINCT capture_id, base, CAST(place AS INTEGER) AS place, a.source_url AS url FROM u), f AS (SELECT *, regexp_extract(base, '^(https?://[^/?#]+)', 1) AS host, regexp_extract(base, '^(https?://[^?#]*/)[^/?#]*', 1) AS folder FROM x) SELECT capture_id, place, kind, CASE WHEN url IS NULL OR url = '' THEN NULL ELSE CASE kind WHEN 'whole' THEN url WHEN 'scheme' THEN 'https:' || regexp_replace(url, '^https?:', '') WHEN 'path' THEN host || regexp_replace(url, '^https?://[^/]+', '') ELSE folder || regexp_extract(url, '([^/]+)$', 1) END END AS url FROM f CROSS JOIN (VALUES ('whole'), ('scheme'), ('path'), ('beside')) v(kind)",
    "full_texts": f"WITH l AS MATERIALIZED (SELECT DISTINCT struct_extract(lawlist, 'law') AS w, struct_extract(lawlist, 'lawEntryVOs') AS v FROM law_detail), p AS (SELECT w.secFutrsLawId AS law_id, list_concat([w.secFutrsLawName, w.bodyAgoCntnt], coalesce(flatten(list_transform(v, lambda e: list_concat([e.title, e.cntnt], coalesce(flatten(list_transform(e.itemList, lambda i: [i.title, i.cntnt])), [])))), []), [w.bodyAftCntnt]) AS parts FROM l), t AS (SELECT law_id, coalesce(array_to_string(list_filter(list_transform(parts, lambda x: {_TRIM('x')}), lambda x: x <> ''), chr(10) || chr(10)), '') AS t FROM p) SELECT DISTINCT law_id, length(t) AS n, sha256(t) AS text_hash FROM t",
    "markdown_bodies": f"WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '[#|-]', ' ', 'g'), '\\r\\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '[{_WS}]+', ' ', 'g'), '^ | $', '', 'g')), lambda x: length(x) > 0) AS f FROM documents WHERE regexp_replace(text, '[{_WS}]+', '', 'g') <> '') SELECT doc_id, sha256(coalesce(array_to_string(f, chr(10)), '')) AS body_hash FROM l",
    "institutions_named": f"WITH w AS MATERIALIZED (SELECT DISTINCT writ_id, struct_extract(metadata, 'name') AS name FROM writ_document) SELECT DISTINCT writ_id, unnest(regexp_extract_all(regexp_replace(name, '^关于对?', ''), '(?:对|，|、|；|。|^|\\s)?((?:\\p{{Han}}{{2,12}}?)(?:{T.INSTITUTION}))', 1)) AS institution FROM w",
    "published_days": f"WITH x AS (SELECT doc_id, pub_date, {_LD('pub_date')} AS day FROM documents) SELECT doc_id, CASE WHEN regexp_matches(pub_date, '^\\d{{4}}-\\d\\d-\\d\\d') THEN substr(pub_date, 1, 10) WHEN day IS NOT NULL AND year(day) BETWEEN 1900 AND 2099 THEN strftime(day, '%Y-%m-%d') ELSE pub_date END AS published FROM x",
    "chinese_numbers": "WITH n AS (SELECT DISTINCT CAST(l_linenumber * day(CAST(l_shipdate AS DATE)) AS INTEGER) AS n FROM lineitem), d AS (SELECT n, ['', '一', '二', '三', '四', '五', '六', '七', '八', '九'] AS c FROM n) SELECT n, CASE WHEN n BETWEEN 1 AND 9 THEN c[n + 1] WHEN n BETWEEN 10 AND 99 THEN CASE WHEN n // 10 > 1 THEN c[n // 10 + 1] ELSE '' END || '十' || c[n % 10 + 1] END AS zh FROM d",
    "ordered_values": "WITH s AS MATERIALIZED (SELECT DISTINCT capture_id, struct_extract(metadata, 'source_category') AS a, web_category_leaf AS b, material_lane AS c, page_role AS d FROM source_record), f AS (SELECT capture_id, nullif(trim(a), '') IS NULL AS na, a, CASE WHEN b IS DISTINCT FROM a THEN b END AS b, CASE WHEN c IS DISTINCT FROM a AND c IS DISTINCT FROM b THEN c END AS c, CASE WHEN d IS DISTINCT FROM a AND d IS DISTINCT FROM b AND d IS DISTINCT FROM c THEN d END AS d FROM s) SELECT capture_id, concat_ws('|', nullif(trim(a), ''), nullif(trim(b), ''), nullif(trim(c), ''), nullif(trim(d), '')) AS v FROM f",
    "provenance": "WITH u AS (SELECT source_record_id AS r, capture_id, struct_extract(metadata, 'source_category') AS a, web_category_leaf AS b, material_lane AS c FROM source_record WHERE source_record_id IS NOT NULL), x AS (SELECT r, 0 AS rank, capture_id, a AS category FROM u UNION ALL SELECT r, 1, capture_id, b FROM u UNION ALL SELECT r, 2, capture_id, c FROM u) SELECT r AS source_record_id, min(rank) AS rank, arg_min(category, (rank, capture_id, category)) AS category FROM x WHERE category IS NOT NULL AND category <> 'unknown' GROUP BY 1",
    "table_ids": "WITH l AS MATERIALIZED (SELECT DISTINCT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, list_filter(flatten(list_transform(struct_extract(lawlist, 'lawEntryVOs'), lambda e: coalesce(e.itemList, []))), lambda i: i.secFutrsLawEntryId IS NOT NULL) AS items FROM law_detail) SELECT law_id, printf('table_%04d', generate_subscripts(items, 1)) AS table_id, unnest(list_transform(items, lambda i: i.secFutrsLawEntryId)) AS item_id FROM l",
    "kept_members": "WITH s AS MATERIALIZED (SELECT DISTINCT capture_id, replace(lower(trim(source_system)), '-', '_') AS source_system, source_record_id AS record_id, coalesce(length(struct_extract(content, 'plain_text')), 0) AS n, CAST(coalesce(nullif(trim(struct_extract(metadata, 'name')), 'unknown'), '') <> '' AS INTEGER) + CAST(coalesce(nullif(trim(struct_extract(metadata, 'fileno')), 'unknown'), '') <> '' AS INTEGER) + CAST(coalesce(nullif(trim(struct_extract(metadata, 'pub_date')), 'unknown'), '') <> '' AS INTEGER) + CAST(coalesce(nullif(trim(struct_extract(metadata, 'pub_org')), 'unknown'), '') <> '' AS INTEGER) AS score FROM source_record) SELECT entity_id, count(DISTINCT capture_id) AS members, arg_min(capture_id, (coalesce(trust_rank, 99) > 3, -n, -score, capture_id)) AS capture_id FROM s JOIN (SELECT DISTINCT * FROM source_map) m USING (source_system, record_id) LEFT JOIN source_trust USING (source_system) GROUP BY 1",
    "page_number_lines": "WITH l AS (SELECT local_file, string_split(plain_text, chr(10)) AS ls FROM asset_text WHERE local_file IS NOT NULL), t AS (SELECT local_file, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line FROM l), n AS (SELECT local_file, line_no, CAST(regexp_extract(line, '[0-9]+') AS INTEGER) AS value FROM t WHERE regexp_matches(line, '^[-—–·~\\f\\s]*[0-9]{1,4}[-—–·~\\s]*$')), r AS MATERIALIZED (SELECT *, value - row_number() OVER (PARTITION BY local_file ORDER BY line_no) AS island FROM n), c AS (SELECT *, sum(CASE WHEN island IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY local_file ORDER BY line_no) AS run FROM (SELECT *, lag(island) OVER (PARTITION BY local_file ORDER BY line_no) AS p FROM r)), g AS (SELECT *, count(*) OVER w AS m, min(value) OVER w AS f, min(line_no) OVER w AS b FROM c WINDOW w AS (PARTITION BY local_file, run)) SELECT local_file, CAST(line_no AS INTEGER) AS line_no, value FROM g WHERE f <= 9 AND (m >= 3 OR (m = 2 AND b = 0))",
    "effective_from": f"WITH l AS MATERIALIZED (SELECT DISTINCT struct_extract(lawlist, 'law') AS x FROM law_detail), y AS (SELECT x.secFutrsLawId AS law_id, x.efctvDate AS e, {_CN.replace('@', 'x.efctvDate')} AS stated, {_CN.replace('@', 'x.pubDate')} AS pub, x.secFutrsLawVersion AS v, regexp_replace(coalesce(x.bodyAftCntnt, ''), '[{_WS}]+', '', 'g') AS t FROM l), z AS (SELECT *, list_filter(list_transform(regexp_extract_all(t, '自((?:19|20)[0-9]{{2}}年[0-9]{{1,2}}月[0-9]{{1,2}}日)起(?:施行|实施|生效|执行)', 1), lambda s: try_cast(regexp_replace(s, '(\\d+)年(\\d+)月(\\d+)日', '\\1-\\2-\\3') AS DATE)), lambda s: s IS NOT NULL) AS named, coalesce(CASE WHEN regexp_matches(v, '^\\d{{8}}$') THEN try_cast(substr(v, 1, 4) || '-' || substr(v, 5, 2) || '-' || substr(v, 7, 2) AS DATE) END, pub) AS once FROM y) SELECT DISTINCT law_id, CASE WHEN len(named) > 0 THEN CASE WHEN abs(stated - named[-1]) > 3 THEN stated ELSE named[-1] END WHEN once IS NOT NULL THEN CASE WHEN abs(stated - once) > 3 THEN stated ELSE once END ELSE stated END AS effective FROM z",
    "projected_metadata": "WITH l AS MATERIALIZED (SELECT struct_extract(lawlist, 'law') AS x FROM law_detail), a AS (SELECT x.secFutrsLawId AS law_id, min(nullif(trim(x.secFutrsLawName), '')) AS name, min(nullif(nullif(trim(x.fileno), ''), 'unknown')) AS fileno, min(nullif(trim(x.lawPubOrgName), '')) AS org FROM l WHERE x.secFutrsLawId IS NOT NULL GROUP BY 1), b AS (SELECT law_id, min(struct_extract(metadata, 'name')) AS n2, min(struct_extract(metadata, 'fileno')) AS f2, min(struct_extract(metadata, 'pub_org')) AS o2 FROM law_document GROUP BY 1) SELECT law_id, coalesce(name, n2) AS name, coalesce(fileno, nullif(f2, 'unknown')) AS fileno, coalesce(org, o2) AS org FROM a LEFT JOIN b USING (law_id)",
}
