"""Queries of records in one shape, audits over them, and remaining functions of texts (SRC-16, JN-03/22/27, AGG-12..21, FIL-14, TXT-09..14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from canonry.functions import text as T
from canonry.functions.dates import china_date, lenient_date
from canonry.operators import resolve
from canonry.plans.lineage import _C, _SHA
from canonry.plans.relations import _FN, _KEYS, _LD, _NT
from canonry.session import table
from canonry.sources import builders


def records(spark, d):
    """SRC-16: records of all sources: per system whether they have a parent, how many, how many have a text, a day, a number."""
    r = builders.records(*(table(spark, d, t) for t in ("law_detail", "source_record", "writ_document", "asset_record", "asset_text")))
    return r.groupBy("system", F.col("parent_record_id").isNotNull().alias("nested")).agg(F.count(F.lit(1)).alias("n"), F.count("plain_text").alias("texts"), F.count("day").alias("days"), F.count("fileno").alias("numbers"), F.sum(F.length("plain_text")).alias("characters"))


def monitor_inventory(spark, d):
    """JN-22: assets listed by records, stored, or with a text: what is visible, missing, removed."""
    listed = table(spark, d, "source_record").select(F.explode("assets").alias("a")).select(F.col("a.local_file").alias("file")).dropna().distinct().withColumn("l", F.lit(True))
    stored = table(spark, d, "asset_record").where("local_file is not null").groupBy(F.col("local_file").alias("file")).agg(F.bool_or(F.col("download_status") == "downloaded").alias("s"))
    read = table(spark, d, "asset_text").select(F.col("local_file").alias("file")).dropna().distinct().withColumn("t", F.lit(True))
    j = listed.join(stored, "file", "full_outer").join(read, "file", "full_outer")
    state = F.when(F.col("l").isNull(), "removed").when(F.coalesce("s", F.lit(False)), "visible").otherwise("missing")
    return j.groupBy(state.alias("visibility"), F.col("t").isNotNull().alias("read")).agg(F.count(F.lit(1)).alias("n"))


def internal_matches(spark, d):
    """JN-03: captures whose title exactly one law has, the days unknown or at most three apart."""
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), T.normal_title(F.col("lawlist.law.secFutrsLawName")).alias("title"), china_date(F.col("lawlist.law.pubDate")).alias("d")).where("title <> ''").distinct()
    one = law.groupBy("title").agg(F.min("law_id").alias("law_id"), F.max("law_id").alias("other"), F.min("d").alias("d0"), F.max("d").alias("d1")).where("law_id = other")
    s = table(spark, d, "source_record").select("capture_id", T.normal_title(F.col("metadata.name")).alias("title"), lenient_date(F.col("metadata.pub_date")).alias("day")).distinct()
    near = F.col("day").isNull() | F.col("d0").isNull() | (F.least(F.abs(F.datediff("day", "d0")), F.abs(F.datediff("day", "d1"))) <= 3)
    return s.join(one, "title").where(near).select("capture_id", "law_id")


def reconciled(spark, d):
    """JN-27: laws against captures that share a title key: the best title score and the best coverage."""
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.col("lawlist.law.secFutrsLawName").alias("name"), F.col("lawlist.law.bodyAftCntnt").alias("body")).where("law_id is not null").distinct()
    key = lambda df, c: df.withColumn("key", F.explode(T.title_keys(F.col(c))))
    s = table(spark, d, "source_record").select("capture_id", F.col("metadata.name").alias("cname"), F.col("content.plain_text").alias("text")).distinct()
    j = key(law, "name").join(key(s, "cname"), "key")
    score = T.overlap_score(T.letters_digits(F.col("name")), T.letters_digits(F.col("cname")))
    g = j.groupBy("law_id").agg(F.count_distinct("capture_id").alias("captures"), F.max(score).alias("title_score"), F.max(T.shingle_coverage(F.col("body"), F.col("text"))).alias("coverage"))
    return law.select("law_id").distinct().join(g, "law_id", "left").select("law_id", F.coalesce("captures", F.lit(0)).alias("captures"), "title_score", "coverage")


def summary_row(spark, d):
    """AGG-12: one row of counts and shares over all captures."""
    s = table(spark, d, "source_record").distinct()
    share = lambda c: F.coalesce(F.round(F.try_divide(F.count_if(c).cast("double"), F.count(F.lit(1))), 6), F.lit(0.0))
    ok = F.lower(F.trim("ingest_status")) == "complete"
    return s.agg(F.count(F.lit(1)).alias("captures"), F.count_distinct("source_record_id").alias("records"), share(ok).alias("complete_share"), share(F.size("assets") > 0).alias("with_assets"), share(~T.blank(F.col("content.plain_text"))).alias("with_text"), share(lenient_date(F.col("metadata.pub_date")).isNotNull()).alias("with_day"))


def asset_roles(spark, d):
    """AGG-15: what the captures that share a digest are to one another."""
    s = table(spark, d, "source_record").select("capture_id", "source_record_id", T.canonical_system(F.col("source_system")).alias("system"), "page_role", F.explode("assets").alias("a")).select("capture_id", "source_record_id", "system", "page_role", T.digest(F.col("a.sha256")).alias("digest")).where("digest is not null").distinct()
    g = s.groupBy("digest").agg(F.count_distinct("capture_id").alias("captures"), F.count_distinct("source_record_id").alias("records"), F.count_distinct("system").alias("systems"), F.count_distinct("page_role").alias("roles"), F.bool_and(F.col("page_role") == "supporting_material").alias("supporting")).where("captures > 1")
    role = F.when(F.col("records") == 1, "same_record").when(F.col("supporting"), "shared_attachment").when(F.col("systems") > 1, "across_systems").when(F.col("roles") == 1, "same_role").otherwise("mixed")
    return g.groupBy(role.alias("role")).agg(F.count(F.lit(1)).alias("digests"), F.sum("captures").alias("captures"))


def party_seeds(spark, d):
    """AGG-18: parties of decisions, else institutions in their titles, as seeds: first spelling, records, targets."""
    w = table(spark, d, "writ_document").select("writ_id", F.col("metadata.name").alias("name"), "parties", "fetched_at").distinct()
    of = F.transform(F.filter("parties", lambda p: p["name"].isNotNull()), lambda p: F.struct(F.coalesce(p["party_type"], F.lit("org")).alias("kind"), p["name"].alias("n"), F.lit("party").alias("origin")))
    named = F.transform(T.institutions(F.regexp_replace("name", "^关于对?", "")), lambda x: F.struct(F.lit("org").alias("kind"), x.alias("n"), F.lit("title").alias("origin")))
    each = w.select("writ_id", "fetched_at", F.explode(F.when(F.size(of) > 0, of).otherwise(named)).alias("x")).select("writ_id", "fetched_at", "x.*").withColumn("key", T.letters_digits(F.col("n"))).where("key <> ''")
    g = each.groupBy("kind", "key").agg(F.min(F.struct("fetched_at", "writ_id", "n", "origin")).alias("f"), F.count_distinct("writ_id").alias("records"))
    return g.select("kind", "key", F.col("f.n").alias("spelling"), F.col("f.origin").alias("origin"), "records")


def audit_summary(spark, d):
    """AGG-21: findings of captures over several dimensions, each finding of a capture once."""
    c = table(spark, d, "source_record").select("capture_id", T.canonical_system(F.col("source_system")).alias("system"), F.coalesce("material_lane", F.lit("none")).alias("lane"), F.coalesce("page_role", F.lit("none")).alias("role"), F.col("content.plain_text").alias("t"), F.col("metadata.name").alias("n"), F.col("metadata.fileno").alias("f"), F.col("metadata.pub_date").alias("p"), "assets").distinct()
    finding = F.array_compact(F.array(F.when(T.blank(F.col("t")), "no_text"), F.when(T.fileno_key(F.col("f")).isNull(), "no_number"), F.when(lenient_date(F.col("p")).isNull(), "no_day"), F.when(F.coalesce(F.size("assets") < 1, F.lit(True)), "no_assets"), F.when(T.blank(F.col("n")), "no_title")))
    f = c.select("capture_id", "system", "lane", "role", F.explode(finding).alias("code")).distinct()
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("dimension"), F.col(k).alias("value")) for k in ("system", "lane", "role"))))
    return f.select("capture_id", "code", each.alias("x")).select("capture_id", "code", "x.*").groupBy("dimension", "value", "code").agg(F.count_distinct("capture_id").alias("captures"))


def entry_items(spark, d):
    """FIL-14: entries and their items as rows, in order."""
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.posexplode("lawlist.lawEntryVOs").alias("place", "e"))
    items = law.select("law_id", "place", F.col("e.secFutrsLawEntryId").alias("entry_id"), F.posexplode_outer("e.itemList").alias("item_place", "i"))
    return items.select("law_id", "place", "entry_id", "item_place", F.col("i.secFutrsLawEntryId").alias("item_id"), F.sha2(F.coalesce("i.cntnt", F.lit("")), 256).alias("item_hash")).distinct()


def sliced(spark, d):
    """TXT-09: what lies between the first and the last ten characters of each closing text."""
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.col("lawlist.law.bodyAftCntnt").alias("t")).where("length(t) > 40").distinct()
    c = T.compact(F.col("t"))
    return law.select("law_id", F.sha2(T.slice_between(F.col("t"), F.substring(c, 1, 10), F.right(c, F.lit(10))), 256).alias("slice_hash"))


def truncated(spark, d):
    """TXT-13: titles as file names of at most 60 bytes."""
    return table(spark, d, "documents").select("doc_id", T.truncate_utf8(F.col("title"), 60).alias("stem"))


def unmangled_names(spark, d):
    """TXT-12: names whose UTF-8 was taken for Latin-1, as they were; here names garbled so are made of all."""
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.col("lawlist.law.secFutrsLawName").alias("name")).where("name is not null").distinct()
    ascii_less = law.where(F.col("name").rlike(r"^[\x{4E00}-\x{9FFF}]+$"))
    bad = F.decode(F.encode("name", "UTF-8"), "ISO-8859-1")
    return ascii_less.select("law_id", F.sha2(T.unmangled(bad), 256).alias("name_hash"))


def relinked(spark, d):
    """TXT-14: Markdown links of assets, rewritten to another folder."""
    s = table(spark, d, "source_record").select("capture_id", F.transform("assets", lambda a: F.concat(F.lit("["), a["asset_id"], F.lit("]("), a["local_file"], F.lit(")"))).alias("l")).where("size(l) > 0").distinct()
    return s.select("capture_id", F.sha2(T.relinked(F.array_join("l", " "), "assets/", "../files/"), 256).alias("md_hash"))


def live_findings(spark, d):
    """JN-21: what matching captures to laws by address, else by title, finds: days that differ, poor coverage, laws that no capture matches."""
    law = table(spark, d, "law_document").select("law_id", T.normal_title(F.col("metadata.name")).alias("title"), lenient_date(F.col("metadata.pub_date")).alias("day"), "full_text").distinct()
    by_title = law.where("title <> ''").groupBy("title").agg(F.min("law_id").alias("law_id"))
    s = table(spark, d, "source_record").select("capture_id", T.normal_title(F.col("metadata.name")).alias("title"), lenient_date(F.col("metadata.pub_date")).alias("cday"), F.col("content.plain_text").alias("text")).distinct()
    m = s.join(by_title, "title").join(law.select("law_id", "day", "full_text"), "law_id")
    differs = F.array_compact(F.array(F.when(F.col("day") != F.col("cday"), "day_differs"), F.when(T.shingle_coverage(F.col("full_text"), F.col("text")) < 0.8, "poor_coverage")))
    found = m.select("law_id", "capture_id", F.explode(differs).alias("finding"))
    lost = law.select("law_id").distinct().join(m.select("law_id"), "law_id", "left_anti").select("law_id", F.lit(None).cast("string").alias("capture_id"), F.lit("unmatched").alias("finding"))
    return found.unionAll(lost).distinct()


def legal_bases(spark, d):
    """HTM-02: titles and articles read from a sentence that cites them, here made of each citation."""
    w = table(spark, d, "writ_document").select("writ_id", F.explode("legal_basis").alias("b")).select("writ_id", F.col("b.law_id").alias("law_id"), F.col("b.entry_title").alias("entry")).distinct()
    law = table(spark, d, "law_document").select("law_id", F.col("metadata.name").alias("name")).where("name is not null").distinct()
    text = F.concat(F.lit("依据《"), F.col("name"), F.lit("》"), F.coalesce("entry", F.lit("")), F.lit("，我会决定："))
    return w.join(law, "law_id").select("writ_id", F.explode(T.legal_basis(text)).alias("x")).select("writ_id", "x.title", "x.entry").distinct()


def merged_rounds(spark, d):
    """JN-05: captures merged into laws in rounds that fill the laws' blanks."""
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), T.fileno_key(F.col("lawlist.law.fileno")).alias("number"), china_date(F.col("lawlist.law.pubDate")).alias("day"), T.title_keys(F.col("lawlist.law.secFutrsLawName")).alias("keys")).where("law_id is not null").distinct()
    s = table(spark, d, "source_record").select("capture_id", "fetched_at", T.fileno_key(F.col("metadata.fileno")).alias("number"), lenient_date(F.col("metadata.pub_date")).alias("day"), T.title_keys(F.col("metadata.name")).alias("keys")).distinct()
    return resolve.overlap_rounds(s, law, "capture_id", "law_id", "keys", ["number", "day"], "fetched_at")


_WS = T.SPACE
_ND = lambda c: f"lower(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"
_P = T.PUNCT.replace("'", "''")
_BARE = lambda c: f"coalesce(regexp_replace({c}, '[{_P}]+', '', 'g'), '')"
_CN = lambda c: f"(DATE '1970-01-01' + CAST(floor(({c} + 28800000) / 86400000.0) AS INTEGER))"
_LAW = "l AS MATERIALIZED (SELECT DISTINCT struct_extract(lawlist, 'law') AS x FROM law_detail)"
QUERIES = {
    "records_shape": records, "monitor_inventory": monitor_inventory, "internal_matches": internal_matches, "reconciled": reconciled, "summary_row": summary_row, "asset_roles": asset_roles, "party_seeds": party_seeds,
    "audit_summary": audit_summary, "entry_items": entry_items, "slices": sliced, "truncated": truncated, "unmangled_names": unmangled_names, "relinked": relinked, "live_findings": live_findings, "legal_bases": legal_bases, "merged_rounds": merged_rounds,
}
SQL = {
    "records_shape": f"WITH {_LAW}, law AS (SELECT DISTINCT 'neris' AS system, x.secFutrsLawId AS id, NULL AS parent, x.secFutrsLawName AS a, nullif(x.fileno, 'unknown') AS f, x.lawPubOrgName AS b, {_CN('x.pubDate')} AS day, x.lawAthrtyStsCde AS c, x.bodyAftCntnt AS t, NULL AS u, NULL AS file FROM l), pg AS MATERIALIZED (SELECT replace(lower(trim(source_system)), '-', '_') AS system, capture_id AS id, struct_extract(metadata, 'name') AS a, nullif(struct_extract(metadata, 'fileno'), 'unknown') AS f, struct_extract(metadata, 'pub_org') AS b, {_LD('struct_extract(metadata, ' + chr(39) + 'pub_date' + chr(39) + ')')} AS day, lower(trim(ingest_status)) AS c, struct_extract(content, 'plain_text') AS t, struct_extract(source, 'page_url') AS u, material_lane AS lane, assets FROM source_record), page AS (SELECT DISTINCT system, id, a, f, b, day, c, t, u, lane FROM pg), lab AS (SELECT asset_id, min(label) AS label FROM asset_record WHERE asset_id IS NOT NULL GROUP BY 1), n AS (SELECT system, id AS parent, b, day, c, lane, unnest(assets) AS x FROM pg), file AS (SELECT DISTINCT system, x.asset_id AS id, parent, label, b, day, c, x.source_url AS u, x.local_file AS file, lane FROM n LEFT JOIN lab ON lab.asset_id = x.asset_id WHERE x.asset_id IS NOT NULL), txt AS (SELECT local_file, min(plain_text) AS plain FROM asset_text GROUP BY 1), writ AS (SELECT DISTINCT writ_id AS id, struct_extract(metadata, 'name') AS a, struct_extract(metadata, 'fileno') AS f, struct_extract(metadata, 'pub_org') AS b, {_CN('struct_extract(metadata, ' + chr(39) + 'dspt_date_ms' + chr(39) + ')')} AS day, body AS t, struct_extract(source, 'page_url') AS u FROM writ_document), z AS (SELECT system, false AS nested, t, day, f FROM law WHERE id IS NOT NULL UNION ALL SELECT system, false, t, day, f FROM page WHERE id IS NOT NULL UNION ALL SELECT system, true, plain, day, NULL FROM file LEFT JOIN txt ON local_file = file UNION ALL SELECT 'writ', false, t, day, f FROM writ WHERE id IS NOT NULL) SELECT system, nested, count(*) AS n, count(t) AS texts, count(day) AS days, count(f) AS numbers, CAST(sum(length(t)) AS BIGINT) AS characters FROM z GROUP BY ALL",
    "monitor_inventory": "WITH l AS (SELECT DISTINCT a.local_file AS file, true AS l FROM (SELECT unnest(assets) AS a FROM source_record) WHERE a.local_file IS NOT NULL), s AS (SELECT local_file AS file, bool_or(download_status = 'downloaded') AS s FROM asset_record WHERE local_file IS NOT NULL GROUP BY 1), t AS (SELECT DISTINCT local_file AS file, true AS t FROM asset_text WHERE local_file IS NOT NULL) SELECT CASE WHEN l IS NULL THEN 'removed' WHEN coalesce(s, false) THEN 'visible' ELSE 'missing' END AS visibility, t IS NOT NULL AS read, count(*) AS n FROM l FULL JOIN s USING (file) FULL JOIN t USING (file) GROUP BY ALL",
    "internal_matches": f"WITH {_LAW}, w AS MATERIALIZED (SELECT DISTINCT x.secFutrsLawId AS law_id, {_NT('x.secFutrsLawName')} AS title, {_CN('x.pubDate')} AS d FROM l), g AS (SELECT title, min(law_id) AS law_id, min(d) AS d0, max(d) AS d1 FROM w WHERE title <> '' GROUP BY 1 HAVING count(DISTINCT law_id) = 1), {_C}, s AS (SELECT DISTINCT capture_id, {_NT('title')} AS title, day FROM c) SELECT capture_id, law_id FROM s JOIN g USING (title) WHERE day IS NULL OR d0 IS NULL OR least(abs(day - d0), abs(day - d1)) <= 3",
    "summary_row": f"WITH {_C}, r AS MATERIALIZED (SELECT DISTINCT * FROM source_record) SELECT count(*) AS captures, count(DISTINCT source_record_id) AS records, round(count(*) FILTER (lower(trim(ingest_status)) = 'complete') / count(*), 6) AS complete_share, round(count(*) FILTER (len(assets) > 0) / count(*), 6) AS with_assets, round(count(*) FILTER (regexp_replace(struct_extract(content, 'plain_text'), '[{_WS}]+', '', 'g') <> '') / count(*), 6) AS with_text, round(count(*) FILTER ({_LD('struct_extract(metadata, ' + chr(39) + 'pub_date' + chr(39) + ')')} IS NOT NULL) / count(*), 6) AS with_day FROM r",
    "asset_roles": f"WITH u AS MATERIALIZED (SELECT capture_id, source_record_id, replace(lower(trim(source_system)), '-', '_') AS system, page_role, unnest(assets) AS a FROM source_record), s AS MATERIALIZED (SELECT DISTINCT capture_id, source_record_id, system, page_role, {_SHA('a.sha256')} AS digest FROM u), g AS (SELECT digest, count(DISTINCT capture_id) AS captures, count(DISTINCT source_record_id) AS records, count(DISTINCT system) AS systems, count(DISTINCT page_role) AS roles, bool_and(page_role = 'supporting_material') AS supporting FROM s WHERE digest IS NOT NULL GROUP BY 1 HAVING count(DISTINCT capture_id) > 1) SELECT CASE WHEN records = 1 THEN 'same_record' WHEN supporting THEN 'shared_attachment' WHEN systems > 1 THEN 'across_systems' WHEN roles = 1 THEN 'same_role' ELSE 'mixed' END AS role, count(*) AS digests, CAST(sum(captures) AS BIGINT) AS captures FROM g GROUP BY 1",
    "party_seeds": f"WITH w AS MATERIALIZED (SELECT DISTINCT writ_id, struct_extract(metadata, 'name') AS name, list_filter(parties, lambda p: p.name IS NOT NULL) AS ps, fetched_at FROM writ_document), e AS (SELECT writ_id, fetched_at, unnest(list_transform(ps, lambda p: {{'kind': coalesce(p.party_type, 'org'), 'n': p.name, 'origin': 'party'}})) AS x FROM w WHERE len(ps) > 0 UNION ALL SELECT writ_id, fetched_at, unnest(list_transform(list_distinct(regexp_extract_all(regexp_replace(name, '^关于对?', ''), '(?:对|，|、|；|。|^|\\s)?((?:\\p{{Han}}{{2,12}}?)(?:{T.INSTITUTION}))', 1)), lambda n: {{'kind': 'org', 'n': n, 'origin': 'title'}})) FROM w WHERE ps IS NULL OR len(ps) = 0), k AS (SELECT writ_id, fetched_at, x.kind AS kind, x.n AS n, x.origin AS origin, {_ND('x.n')} AS key FROM e) SELECT kind, key, arg_min(n, (fetched_at, writ_id, n)) AS spelling, arg_min(origin, (fetched_at, writ_id, n)) AS origin, count(DISTINCT writ_id) AS records FROM k WHERE key <> '' GROUP BY ALL",
    "audit_summary": f"WITH {_C}, m AS MATERIALIZED (SELECT DISTINCT capture_id, system, coalesce(material_lane, 'none') AS lane, coalesce(page_role, 'none') AS role, body, title, fileno, day, assets FROM c), f AS (SELECT capture_id, system, lane, role, 'no_text' AS code FROM m WHERE body IS NULL OR regexp_replace(body, '[{_WS}]+', '', 'g') = '' UNION SELECT capture_id, system, lane, role, 'no_number' FROM m WHERE {_FN('fileno')} IS NULL UNION SELECT capture_id, system, lane, role, 'no_day' FROM m WHERE day IS NULL UNION SELECT capture_id, system, lane, role, 'no_assets' FROM m WHERE coalesce(len(assets), 0) = 0 UNION SELECT capture_id, system, lane, role, 'no_title' FROM m WHERE title IS NULL OR regexp_replace(title, '[{_WS}]+', '', 'g') = ''), x AS (SELECT capture_id, code, 'system' AS dimension, system AS value FROM f UNION ALL SELECT capture_id, code, 'lane', lane FROM f UNION ALL SELECT capture_id, code, 'role', role FROM f) SELECT dimension, value, code, count(DISTINCT capture_id) AS captures FROM x GROUP BY ALL",
    "live_findings": f"WITH l AS MATERIALIZED (SELECT DISTINCT law_id, {_NT('struct_extract(metadata, ' + chr(39) + 'name' + chr(39) + ')')} AS title, {_LD('struct_extract(metadata, ' + chr(39) + 'pub_date' + chr(39) + ')')} AS day, {_ND('full_text')} AS p FROM law_document), t AS (SELECT title, min(law_id) AS law_id FROM l WHERE title <> '' GROUP BY 1), {_C}, s AS MATERIALIZED (SELECT DISTINCT capture_id, {_NT('title')} AS title, day AS cday, {_ND('body')} AS q FROM c), m AS MATERIALIZED (SELECT t.law_id, capture_id, l.day <> cday AS d, len(list_filter(range(1, greatest(length(p) - 20 + 1, 1) + 1, 20), lambda i: contains(q, substr(p, i, 20)))) / len(range(1, greatest(length(p) - 20 + 1, 1) + 1, 20)) < 0.8 AND length(p) > 0 AS c FROM s JOIN t USING (title) JOIN l ON l.law_id = t.law_id) SELECT DISTINCT law_id, capture_id, 'day_differs' AS finding FROM m WHERE d UNION ALL SELECT DISTINCT law_id, capture_id, 'poor_coverage' FROM m WHERE c UNION ALL SELECT DISTINCT law_id, NULL, 'unmatched' FROM l WHERE law_id NOT IN (SELECT law_id FROM m)",
    "legal_bases": "WITH w AS MATERIALIZED (SELECT DISTINCT writ_id, b.law_id AS law_id, b.entry_title AS entry FROM (SELECT writ_id, unnest(legal_basis) AS b FROM writ_document)), l AS MATERIALIZED (SELECT DISTINCT law_id, struct_extract(metadata, 'name') AS name FROM law_document) SELECT DISTINCT writ_id, name AS title, CASE WHEN regexp_matches(entry, '^第[一二三四五六七八九十百零〇0-9]+条') THEN regexp_extract(entry, '^第[一二三四五六七八九十百零〇0-9]+条') END AS entry FROM w JOIN l USING (law_id) WHERE length(name) BETWEEN 2 AND 120 AND NOT regexp_matches(name, '[《》]')",
    "entry_items": "WITH l AS MATERIALIZED (SELECT DISTINCT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, struct_extract(lawlist, 'lawEntryVOs') AS v FROM law_detail), e AS (SELECT law_id, generate_subscripts(v, 1) - 1 AS place, unnest(v) AS e FROM l), i AS (SELECT law_id, place, e.secFutrsLawEntryId AS entry_id, generate_subscripts(e.itemList, 1) - 1 AS item_place, unnest(e.itemList) AS i FROM e WHERE len(e.itemList) > 0 UNION ALL SELECT law_id, place, e.secFutrsLawEntryId, NULL, NULL FROM e WHERE e.itemList IS NULL OR len(e.itemList) = 0) SELECT DISTINCT law_id, CAST(place AS INTEGER) AS place, entry_id, CAST(item_place AS INTEGER) AS item_place, i.secFutrsLawEntryId AS item_id, sha256(coalesce(i.cntnt, '')) AS item_hash FROM i",
    "slices": f"WITH {_LAW}, t AS MATERIALIZED (SELECT DISTINCT x.secFutrsLawId AS law_id, regexp_replace(x.bodyAftCntnt, '[{_WS}]+', '', 'g') AS c FROM l WHERE length(x.bodyAftCntnt) > 40), s AS (SELECT law_id, c, substr(c, 1, 10) AS a, right(c, 10) AS z FROM t) SELECT law_id, CASE WHEN (length(c) - length(replace(c, a, ''))) / length(a) = 1 AND (length(c) - length(replace(c, z, ''))) / length(z) = 1 AND strpos(c, a) < strpos(c, z) THEN sha256(substr(c, strpos(c, a), strpos(c, z) - strpos(c, a))) END AS slice_hash FROM s",
    "truncated": "WITH c AS (SELECT doc_id, title, list_transform(range(1, CAST(length(title) AS BIGINT) + 1), lambda i: substr(title, 1, i)) AS p FROM documents) SELECT doc_id, CASE WHEN title IS NOT NULL THEN coalesce(list_filter(p, lambda x: strlen(x) <= 60)[-1], '') END AS stem FROM c",
    "unmangled_names": f"WITH {_LAW} SELECT DISTINCT x.secFutrsLawId AS law_id, sha256(x.secFutrsLawName) AS name_hash FROM l WHERE regexp_matches(x.secFutrsLawName, '^[\\x{{4E00}}-\\x{{9FFF}}]+$')",
    "relinked": "WITH s AS MATERIALIZED (SELECT DISTINCT capture_id, assets FROM source_record WHERE len(assets) > 0) SELECT DISTINCT capture_id, sha256(array_to_string(list_filter(list_transform(assets, lambda a: '[' || a.asset_id || '](' || regexp_replace(a.local_file, '^assets/', '../files/') || ')'), lambda x: x IS NOT NULL), ' ')) AS md_hash FROM s",
    "reconciled": f"WITH {_LAW}, w AS MATERIALIZED (SELECT DISTINCT x.secFutrsLawId AS law_id, x.secFutrsLawName AS name, x.bodyAftCntnt AS body FROM l WHERE x.secFutrsLawId IS NOT NULL), s AS MATERIALIZED (SELECT DISTINCT capture_id, struct_extract(metadata, 'name') AS cname, struct_extract(content, 'plain_text') AS text FROM source_record), a AS MATERIALIZED (SELECT law_id, name, body, unnest({_KEYS('name')}) AS key FROM w WHERE name IS NOT NULL), b AS MATERIALIZED (SELECT capture_id, cname, text, unnest({_KEYS('cname')}) AS key FROM s WHERE cname IS NOT NULL), j AS MATERIALIZED (SELECT law_id, capture_id, {_ND('name')} AS n, {_ND('cname')} AS m, {_ND('body')} AS p, {_ND('text')} AS q FROM a JOIN b USING (key)), v AS (SELECT law_id, capture_id, CASE WHEN length(n) = 0 OR length(m) = 0 THEN 0.0 WHEN contains(n, m) OR contains(m, n) THEN 1.0 ELSE round(len(list_intersect(list_distinct(string_split(n, '')), list_distinct(string_split(m, '')))) / greatest(len(list_distinct(string_split(n, ''))), len(list_distinct(string_split(m, '')))), 6) END AS score, CASE WHEN length(p) > 0 THEN round(len(list_filter(range(1, greatest(length(p) - 20 + 1, 1) + 1, 20), lambda i: contains(q, substr(p, i, 20)))) / len(range(1, greatest(length(p) - 20 + 1, 1) + 1, 20)), 6) END AS cov FROM j), g AS (SELECT law_id, count(DISTINCT capture_id) AS captures, max(score) AS title_score, max(cov) AS coverage FROM v GROUP BY 1) SELECT law_id, coalesce(captures, 0) AS captures, title_score, coverage FROM (SELECT DISTINCT law_id FROM w) LEFT JOIN g USING (law_id)",
}
