"""Queries of the scalar functions: titles, numbers, bodies, addresses, dates, ids (TXT, DAT, HSH, URL, NUM)."""

from __future__ import annotations

from pyspark.sql import functions as F

from canonry.functions import ids
from canonry.functions import text as T
from canonry.functions.dates import china_date, lenient_date
from canonry.plans.relations import _BARE, _CU, _NARROW
from canonry.session import table

_WS, _P = T.SPACE, T.PUNCT
_Q = _P.replace("'", "''")
_META = "WITH m AS MATERIALIZED (SELECT DISTINCT capture_id, struct_extract(metadata, 'name') AS name, struct_extract(metadata, 'fileno') AS fileno, struct_extract(metadata, 'pub_date') AS pub_date, struct_extract(source, 'page_url') AS page_url FROM source_record)"
_MARKS = _WS + "·•,，。；;:：()（）\\[\\]【】《》“”\"''、—-"
_CLEAN = rf"regexp_replace(regexp_replace(regexp_replace(@, '^[{_WS}]+|[{_WS}]+$', '', 'g'), '{T.ATTACHMENT}', ''), '{T.SUFFIX}', '')"
_NORMAL = rf"lower(regexp_replace({_CLEAN}, '[{_MARKS}]+', '', 'g'))"


def _on(template: str, value: str) -> str:
    return template.replace("@", value)


def _meta(spark, d):
    s = table(spark, d, "source_record")
    return s.select("capture_id", F.col("metadata.name").alias("name"), F.col("metadata.fileno").alias("fileno"), F.col("metadata.pub_date").alias("pub_date"), F.col("source.page_url").alias("page_url")).distinct()


def title_norm(spark, d):
    return _meta(spark, d).select("capture_id", T.normal_title(F.col("name")).alias("title"), F.lower("name").rlike(T.DRAFT).alias("is_draft"), F.lower("name").rlike(T.TRIAL).alias("is_trial"))


def title_quoted(spark, d):
    return _meta(spark, d).select("capture_id", F.explode(F.array_distinct(T.quoted_titles(F.col("name")))).alias("quoted"))


def title_keys(spark, d):
    return _meta(spark, d).select("capture_id", F.array_join(F.array_sort(T.title_keys(F.col("name"))), ",").alias("keys"))


def fileno_keys(spark, d):
    return _meta(spark, d).select("capture_id", T.fileno_key(F.col("fileno")).alias("number"))


def number_sets(spark, d):
    """TXT-06: keys of document numbers as they are written."""
    return _meta(spark, d).select("capture_id", F.array_join(T.number_keys(F.col("fileno")), ",").alias("keys"))


def body_hashes(spark, d):
    return table(spark, d, "documents").select("doc_id", T.body_hash(F.col("text")).alias("hash"))


def lines_clean(spark, d):
    return table(spark, d, "law_document").select("law_id", F.sha2(T.clean_lines(F.col("full_text")), 256).alias("clean_hash")).distinct()


def letters_digits(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length(T.letters_digits(F.col("title"))).alias("n"), T.letters_digits(F.col("title")).alias("letters"))


def coverage(spark, d):
    a = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.col("lawlist.law.bodyAftCntnt").alias("body")).distinct()
    b = table(spark, d, "law_document").select("law_id", "full_text").distinct()
    return a.join(b, "law_id").select("law_id", T.shingle_coverage(F.col("body"), F.col("full_text")).alias("coverage"))


def title_overlap(spark, d):
    a = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.col("lawlist.law.secFutrsLawName").alias("a")).distinct()
    b = table(spark, d, "law_document").select("law_id", F.col("metadata.name").alias("b")).distinct()
    return a.join(b, "law_id").select("law_id", T.overlap_score(T.letters_digits(F.col("a")), T.letters_digits(F.col("b"))).alias("score"))


def urls(spark, d):
    u = F.col("page_url")
    return _meta(spark, d).select("capture_id", T.canonical_url(u).alias("url"), T.canonical_url(u, False).alias("bare_url"), F.lower(F.regexp_extract(u, "^[A-Za-z]+://([^/:?#]+)", 1)).alias("host"), F.regexp_extract(u, r"\.([A-Za-z0-9]{1,5})(?:[?#].*)?$", 1).alias("suffix"))


def entity_ids(spark, d):
    return table(spark, d, "source_map").select("source_system", "record_id", ids.entity_id(F.col("source_system"), F.col("record_id")).alias("made_id"))


def fingerprints(spark, d):
    s = table(spark, d, "source_record")
    m = "metadata."
    shas = F.array_sort(F.filter(F.transform("assets", lambda a: F.concat_ws(":", a["asset_id"], a["sha256"])), lambda x: F.length(x) > 0))
    return s.select("capture_id", ids.text_fingerprint(F.col("content.plain_text")).alias("text_hash"), ids.fields_fingerprint(name=F.col(m + "name"), fileno=F.col(m + "fileno"), pub_org=F.col(m + "pub_org"), pub_date=F.col(m + "pub_date")).alias("fields_hash"), F.sha2(F.array_join(F.coalesce(shas, F.array().cast("array<string>")), ","), 256).alias("assets_hash")).distinct()


def dates_parsed(spark, d):
    return _meta(spark, d).select("capture_id", lenient_date(F.col("pub_date")).alias("day"), F.expr("try_to_date(substr(pub_date, 1, 10), 'yyyy-MM-dd')").alias("iso_day"))


def dates_china(spark, d):
    law = table(spark, d, "law_detail").select("lawlist.law.*").select(F.col("secFutrsLawId").alias("law_id"), china_date(F.col("pubDate")).alias("published"), china_date(F.col("efctvDate")).alias("effective")).distinct()
    return law.withColumn("days", F.datediff("effective", "published"))


def effective_dates(spark, d):
    found = F.regexp_extract_all(T.compact(F.col("full_text")), F.lit("自((?:19|20)[0-9]{2}年[0-9]{1,2}月[0-9]{1,2}日)起"), 1)
    days = F.filter(F.transform(found, lenient_date), lambda x: x.isNotNull())
    meta = lenient_date(F.col("metadata.pub_date"))
    return table(spark, d, "law_document").select("law_id", F.coalesce(F.try_element_at(days, F.lit(-1)), meta).alias("effective")).distinct()


def confidence_bands(spark, d):
    c = F.col("confidence")
    band = F.when(c >= 0.99, "certain").when(c >= 0.9, "strong").when(c >= 0.75, "moderate").when(c.isNotNull(), "low")
    return table(spark, d, "catalog_relation").distinct().groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(c), 6).alias("mean"))


def entries_flat(spark, d):
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.posexplode("lawlist.lawEntryVOs").alias("place", "e"))
    filled = law.where("length(trim(coalesce(e.title, ''))) > 0 or length(trim(coalesce(e.cntnt, ''))) > 0")
    return filled.select("law_id", "place", F.col("e.secFutrsLawEntryId").alias("entry_id"), F.col("e.title").alias("title"), F.coalesce(F.size("e.itemList"), F.lit(0)).alias("items")).distinct()


_DAY = r"try_cast(regexp_replace(@, '^\s*(\d{4})\s*[-/.年]?\s*(\d{1,2})\s*[-/.月]?\s*(\d{1,2})\s*日?(?:[\sT].*)?$', '\1-\2-\3') AS DATE)"
_LENIENT = rf"CASE WHEN regexp_matches(@, '^\s*\d{{8}}\s*$') OR regexp_matches(@, '^\s*\d{{4}}\s*[-/.年]\s*\d{{1,2}}\s*[-/.月]\s*\d{{1,2}}\s*日?([\sT].*)?$') THEN {_DAY} END"
_ND = r"regexp_replace(@, '[^\p{L}\p{N}]', '', 'g')"
_CN = "(DATE '1970-01-01' + CAST(floor((@ + 28800000) / 86400000.0) AS INTEGER))"

QUERIES = {
    "title_norm": title_norm, "title_quoted": title_quoted, "title_keys": title_keys, "fileno_keys": fileno_keys, "number_sets": number_sets, "body_hashes": body_hashes, "lines_clean": lines_clean,
    "letters_digits": letters_digits, "shingle_coverage": coverage, "title_overlap": title_overlap, "urls_canonical": urls, "entity_ids": entity_ids, "fingerprints": fingerprints,
    "dates_parsed": dates_parsed, "dates_china": dates_china, "effective_dates": effective_dates, "confidence_bands": confidence_bands, "entries_flat": entries_flat,
}
SQL = {
    "title_norm": f"{_META} SELECT capture_id, {_on(_NORMAL, 'name')} AS title, regexp_matches(lower(name), '{T.DRAFT}') AS is_draft, regexp_matches(lower(name), '{T.TRIAL}') AS is_trial FROM m",
    "title_quoted": f"{_META} SELECT DISTINCT capture_id, unnest(regexp_extract_all(name, '《([^《》]{{4,120}})》', 1)) AS quoted FROM m",
    "title_keys": f"{_META}, k AS (SELECT capture_id, name, list_prepend(name, regexp_extract_all(name, '《([^《》]{{4,120}})》', 1)) AS l FROM m), n AS (SELECT capture_id, name, list_filter(list_distinct(list_transform(l, lambda t: {_on(_NORMAL, f'''regexp_replace(regexp_replace(lower({_on(_CLEAN, 't')}), '[(（]?(?:{T.DRAFT})[)）]?', '', 'g'), '^(?:关于)?(?:公开征求意见|征求意见)(?:的)?(?:通知|公告)?', '')''')})), lambda t: length(t) > 0) AS f FROM k) SELECT capture_id, CASE WHEN name IS NOT NULL THEN coalesce(array_to_string(list_sort(f), ','), '') END AS keys FROM n",
    "fileno_keys": f"{_META}, x AS (SELECT capture_id, {_BARE('fileno')} AS n FROM m) SELECT capture_id, CASE WHEN regexp_matches(n, '^\\p{{L}}+(?:19|20)\\d{{2}}\\d+$') THEN n END AS number FROM x",
    "number_sets": f"{_META}, x AS (SELECT capture_id, lower(regexp_replace({_NARROW('fileno')}, '[{_MARKS}]+', '', 'g')) AS n FROM m) SELECT capture_id, CASE WHEN n IS NOT NULL THEN concat_ws(',', nullif(n, ''), nullif(CASE WHEN regexp_extract(n, '第[0-9]+号') <> n THEN regexp_extract(n, '第[0-9]+号') END, '')) END AS keys FROM x",
    "body_hashes": f"WITH x AS (SELECT doc_id, regexp_replace(text, '[{_WS}]+', '', 'g') AS c FROM documents) SELECT doc_id, CASE WHEN length(c) >= 80 THEN sha256(c) END AS hash FROM x",
    "lines_clean": f"WITH l AS (SELECT law_id, list_filter(list_transform(string_split(regexp_replace(full_text, '\\r\\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '[{_WS}]+', ' ', 'g'), '^ | $', '', 'g')), lambda x: length(x) > 0) AS f, full_text FROM law_document) SELECT DISTINCT law_id, CASE WHEN full_text IS NOT NULL THEN sha256(coalesce(array_to_string(f, chr(10)), '')) END AS clean_hash FROM l",
    "letters_digits": f"SELECT doc_id, length(lower({_on(_ND, 'title')})) AS n, lower({_on(_ND, 'title')}) AS letters FROM documents",
    "shingle_coverage": f"WITH a AS MATERIALIZED (SELECT DISTINCT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, lower({_on(_ND, '''struct_extract(struct_extract(lawlist, 'law'), 'bodyAftCntnt')''')}) AS s FROM law_detail), b AS (SELECT DISTINCT law_id, full_text IS NULL AS no_text, lower({_on(_ND, 'full_text')}) AS t FROM law_document), j AS (SELECT law_id, s, t, range(1, greatest(length(s) - 20 + 1, 1) + 1, 20) AS starts FROM a JOIN b USING (law_id)) SELECT law_id, CASE WHEN length(s) > 0 THEN round(len(list_filter(starts, lambda i: contains(t, substr(s, i, 20)))) / len(starts), 6) END AS coverage FROM j",
    "title_overlap": f"WITH a AS MATERIALIZED (SELECT DISTINCT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, lower({_on(_ND, '''struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawName')''')}) AS a FROM law_detail), b AS MATERIALIZED (SELECT DISTINCT law_id, lower({_on(_ND, '''struct_extract(metadata, 'name')''')}) AS b FROM law_document) SELECT law_id, CASE WHEN length(a) = 0 OR length(b) = 0 THEN 0.0 WHEN contains(a, b) OR contains(b, a) THEN 1.0 ELSE round(len(list_intersect(list_distinct(string_split(a, '')), list_distinct(string_split(b, '')))) / greatest(len(list_distinct(string_split(a, ''))), len(list_distinct(string_split(b, '')))), 6) END AS score FROM a JOIN b USING (law_id)",
    "urls_canonical": f"{_META} SELECT capture_id, {_CU('page_url')} AS url, {_CU('page_url', False)} AS bare_url, lower(regexp_extract(page_url, '^[A-Za-z]+://([^/:?#]+)', 1)) AS host, regexp_extract(page_url, '\\.([A-Za-z0-9]{{1,5}})([?#].*)?$', 1) AS suffix FROM m",
    "fingerprints": f"WITH r AS MATERIALIZED (SELECT DISTINCT capture_id, struct_extract(content, 'plain_text') AS t, struct_extract(metadata, 'name') AS a, struct_extract(metadata, 'fileno') AS b, struct_extract(metadata, 'pub_org') AS o, struct_extract(metadata, 'pub_date') AS p, assets FROM source_record), x AS (SELECT *, list_sort(list_filter(list_transform(assets, lambda y: concat_ws(':', y.asset_id, y.sha256)), lambda y: y <> '')) AS l FROM r) SELECT DISTINCT capture_id, sha256(regexp_replace(regexp_replace(coalesce(t, ''), '[{_WS}]+', ' ', 'g'), '^ | $', '', 'g')) AS text_hash, sha256(concat_ws(chr(31), CASE WHEN b <> '' THEN 'fileno=' || b END, CASE WHEN a <> '' THEN 'name=' || a END, CASE WHEN p <> '' THEN 'pub_date=' || p END, CASE WHEN o <> '' THEN 'pub_org=' || o END)) AS fields_hash, sha256(coalesce(array_to_string(l, ','), '')) AS assets_hash FROM x",
    "entity_ids": "SELECT source_system, record_id, 'law_' || substr(sha256(source_system || ':' || record_id), 1, 24) AS made_id FROM source_map",
    "dates_parsed": f"{_META} SELECT capture_id, {_on(_LENIENT, 'pub_date')} AS day, CASE WHEN regexp_matches(pub_date, '^\\d{{4}}-\\d\\d-\\d\\d') THEN try_cast(substr(pub_date, 1, 10) AS DATE) END AS iso_day FROM m",
    "dates_china": f"WITH l AS MATERIALIZED (SELECT struct_extract(lawlist, 'law') AS law FROM law_detail) SELECT DISTINCT law.secFutrsLawId AS law_id, {_on(_CN, 'law.pubDate')} AS published, {_on(_CN, 'law.efctvDate')} AS effective, CAST({_on(_CN, 'law.efctvDate')} - {_on(_CN, 'law.pubDate')} AS INTEGER) AS days FROM l",
    "effective_dates": f"WITH x AS MATERIALIZED (SELECT law_id, struct_extract(metadata, 'pub_date') AS p, regexp_extract_all(regexp_replace(full_text, '[{_WS}]+', '', 'g'), '自((?:19|20)[0-9]{{2}}年[0-9]{{1,2}}月[0-9]{{1,2}}日)起', 1) AS f FROM law_document), y AS (SELECT law_id, p, list_filter(list_transform(f, lambda s: try_cast(regexp_replace(s, '(\\d+)年(\\d+)月(\\d+)日', '\\1-\\2-\\3') AS DATE)), lambda v: v IS NOT NULL) AS v FROM x) SELECT DISTINCT law_id, coalesce(v[-1], {_on(_LENIENT, 'p')}) AS effective FROM y",
    "confidence_bands": "WITH r AS (SELECT DISTINCT * FROM catalog_relation) SELECT CASE WHEN confidence >= 0.99 THEN 'certain' WHEN confidence >= 0.9 THEN 'strong' WHEN confidence >= 0.75 THEN 'moderate' WHEN confidence IS NOT NULL THEN 'low' END AS band, count(*) AS n, round(avg(confidence), 6) AS mean FROM r GROUP BY 1",
    "entries_flat": "WITH l AS MATERIALIZED (SELECT DISTINCT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, struct_extract(lawlist, 'lawEntryVOs') AS v FROM law_detail), e AS (SELECT law_id, generate_subscripts(v, 1) - 1 AS place, unnest(v) AS e FROM l), x AS MATERIALIZED (SELECT law_id, place, e.secFutrsLawEntryId AS entry_id, e.title AS title, e.cntnt AS cntnt, coalesce(len(e.itemList), 0) AS items FROM e) SELECT DISTINCT law_id, CAST(place AS INTEGER) AS place, entry_id, title, CAST(items AS INTEGER) AS items FROM x WHERE length(trim(coalesce(title, ''))) > 0 OR length(trim(coalesce(cntnt, ''))) > 0",
}
