"""Queries over records: duplicate audits, folds, windows, changes, checks and reports (AGG-13..24, WIN, STR, VAL, SRC-19)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canonry.functions import text as T
from canonry.functions.dates import lenient_date
from canonry.operators import changes, quality, resolve, windows
from canonry.operators.cascade import Rule, decide, reasons
from canonry.plans.relations import _CU, _FN, _LD, _NT
from canonry.session import table


def _captures(spark, d):
    s = table(spark, d, "source_record")
    return s.select(
        "capture_id", "source_record_id", T.canonical_system(F.col("source_system")).alias("system"), F.col("metadata.name").alias("name"), F.col("metadata.fileno").alias("fileno"),
        F.col("metadata.pub_date").alias("pub_date"), F.col("metadata.pub_org").alias("pub_org"), F.length("content.plain_text").alias("n"), F.col("content.plain_text").alias("body"), "assets", "fetched_at", "ingest_status",
    ).distinct()


def dup_audit(spark, d):
    """Groups of captures with equal titles or bodies: kind, key, size, records and severity."""
    c = _captures(spark, d).select("capture_id", "source_record_id", "n", T.normal_title(F.col("name")).alias("title"), T.body_hash(F.col("body")).alias("hash"), T.fileno_key(F.col("fileno")).alias("number"), lenient_date(F.col("pub_date")).alias("day"))
    each = c.select("*", F.explode(F.array(F.struct(F.lit("title").alias("kind"), F.col("title").alias("key")), F.struct(F.lit("body").alias("kind"), F.col("hash").alias("key")))).alias("x")).select("*", "x.*").where("key <> ''")
    g = each.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("size"), F.min("source_record_id").alias("r0"), F.max("source_record_id").alias("r1"), F.min("number").alias("n0"), F.max("number").alias("n1"), F.min("day").alias("d0"), F.max("day").alias("d1"), F.min("n").alias("least"), F.max("n").alias("most"))
    high = (F.col("n0") == F.col("n1")) | (F.col("d0") == F.col("d1")) | ((F.col("most") - F.col("least")) <= 0.05 * F.col("most"))
    role = F.when(F.col("r0") == F.col("r1"), "recaptured").otherwise("across_records")
    return g.where("size > 1").select("kind", F.sha2("key", 256).alias("key_hash"), "size", F.when(F.coalesce(high, F.lit(False)), "high").otherwise("medium").alias("severity"), role.alias("role"))


def dedupe_plan(spark, d):
    """What to do with the groups of the audit, counted by kind and severity."""
    a = dup_audit(spark, d)
    plan = decide([Rule("same_record", F.col("role") == "recaptured", "auto_merge", 1.0), Rule("same_body", F.col("kind") == "body", "merge", 0.95), Rule("high_title", F.col("severity") == "high", "review", 0.8)], Rule("other", F.lit(True), "keep", 0.5))
    return a.withColumn("p", plan).groupBy("kind", "severity", F.col("p.outcome").alias("plan"), F.col("p.rule_id").alias("rule_id")).agg(F.count(F.lit(1)).alias("groups"), F.sum("size").alias("records"))


def merge_fold(spark, d):
    """One record per source record: first known values, longest body, union of assets."""
    c = _captures(spark, d).withColumn("asset_ids", F.coalesce(F.transform("assets", lambda a: a["asset_id"]), F.array().cast("array<string>")))
    f = resolve.fold(c, "source_record_id", "capture_id", ["name", "fileno", "pub_date", "pub_org"], ["body"], ["asset_ids"])
    return f.select("source_record_id", "merged", "name", "fileno", "pub_date", "pub_org", F.length("body").alias("body_length"), F.array_join("asset_ids", ",").alias("asset_ids"))


def anchors(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    a = resolve.anchor_dedupe(o, ["o_custkey", "o_orderpriority"], "day", "o_orderkey")
    return a.where("anchor_id <> o_orderkey").select("o_orderkey", "anchor_id")


def completeness(spark, d):
    c = _captures(spark, d)
    known = lambda x: (F.coalesce(F.nullif(F.trim(F.col(x)), F.lit("unknown")), F.lit("")) != "").cast("int")
    return c.select("capture_id", (known("name") + known("fileno") + known("pub_date") + known("pub_org")).alias("score"))


def asset_merge(spark, d):
    """Assets merged by digest, else by file, else by address."""
    a = table(spark, d, "asset_record").distinct().withColumn("sha", T.digest(F.col("sha256")))
    key = F.coalesce(F.concat(F.lit("sha:"), "sha"), F.concat(F.lit("file:"), F.nullif("local_file", F.lit(""))), F.concat(F.lit("url:"), "source_url"))
    return a.groupBy(key.alias("key")).agg(F.countDistinct("asset_id").alias("assets"), F.min("asset_id").alias("first_asset"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))


def asset_status(spark, d):
    a = table(spark, d, "asset_record").distinct()
    return a.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("download_status") == "downloaded").alias("downloaded"), F.count_if(F.col("size_bytes") == 0).alias("empty"), F.round(F.try_divide(F.count_if(F.col("download_status") == "downloaded"), F.count(F.lit(1))), 6).alias("share"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("bytes"))


def series_gaps(spark, d):
    """Serial numbers that a series (issuer and year) lacks between its first and last.

    Found between neighbours, so no range of a series is laid out.
    """
    n = table(spark, d, "law_detail").select(T.fileno_key(F.col("lawlist.law.fileno")).alias("k")).where("k is not null")
    p = r"^(\p{L}+(?:19|20)\d{2})(\d+)$"
    s = n.select(F.regexp_extract("k", p, 1).alias("series"), F.regexp_extract("k", p, 2).cast("int").alias("no")).distinct()
    nxt = s.withColumn("next", F.lead("no").over(W.partitionBy("series").orderBy("no")))
    return nxt.where("next > no + 1").select("series", (F.col("no") + 1).alias("first_missing"), (F.col("next") - 1).alias("last_missing"))


def subject_seeds(spark, d):
    """Parties of decisions, once per type and normal name, with their number of writs."""
    p = table(spark, d, "writ_document").select("writ_id", F.explode("parties").alias("p")).select("writ_id", F.col("p.party_type").alias("party_type"), F.col("p.name").alias("name")).where("length(trim(name)) > 0").distinct()
    g = p.groupBy("party_type", T.letters_digits(F.col("name")).alias("norm")).agg(F.countDistinct("writ_id").alias("writs"), F.min("name").alias("name"))
    return g.select(F.concat(F.lit("subject_"), F.substring(F.sha2(F.concat_ws(":", "party_type", "norm"), 256), 1, 24)).alias("seed_id"), "party_type", "name", "writs")


def law_citations(spark, d):
    c = table(spark, d, "writ_document").select("writ_id", F.explode("legal_basis").alias("b")).select("writ_id", F.col("b.law_id").alias("law_id"), F.col("b.entry_title").alias("entry_title")).distinct()
    # Distinct pairs first, with partial results: one law is cited far more than the others.
    return c.groupBy("law_id").agg(F.count(F.lit(1)).alias("citations"), F.countDistinct("writ_id").alias("writs"))


def candidate_evidence(spark, d):
    """Addresses that several captures share: the first capture and all categories."""
    s = table(spark, d, "source_record").select(T.canonical_url(F.col("source.page_url")).alias("url"), "capture_id", F.col("web_category_leaf").alias("leaf"))
    return s.groupBy("url").agg(F.min("capture_id").alias("first_capture"), F.array_join(F.array_sort(F.collect_set("leaf")), ",").alias("leaves"))


def version_edges(spark, d):
    v = F.regexp_replace(F.col("version"), "[^0-9]", "")
    laws = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.col("lawlist.law.lawPubOrgName").alias("org"), F.col("lawlist.law.secFutrsLawVersion").alias("version")).where("org is not null").distinct()
    return windows.version_edges(laws, "org", F.when(v != "", v.cast("bigint")), "law_id").select("org", "from_id", "to_id")


def run_islands(spark, d):
    """Runs of days in a row on which a user has events."""
    e = table(spark, d, "events").select("user_id", F.datediff(F.col("ts").cast("date"), F.lit("2000-01-01").cast("date")).alias("day")).distinct()
    return windows.islands(e, ["user_id"], "day", "day").where("length >= 3").select("user_id", "first", "last", "length")


def file_names(spark, d):
    c = table(spark, d, "documents").select("doc_id", F.coalesce(T.normal_title(F.col("title")), F.lit("untitled")).alias("stem"))
    return windows.suffixed(c, "stem", "doc_id").select("doc_id", "file_name")


def latest_capture(spark, d):
    c = _captures(spark, d).select("source_record_id", "capture_id", "system", "fetched_at")
    return windows.latest(c, ["source_record_id"], ["fetched_at", "capture_id"]).select("source_record_id", "capture_id", "system")


def group_ordinals(spark, d):
    """Days on which several documents were published, numbered by their first document."""
    g = table(spark, d, "documents").select("doc_id", lenient_date(F.col("pub_date")).alias("day")).where("day is not null").groupBy("day").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = windows.ranked(g, ["first"])
    return ranked.select(F.format_string("day:%04d", F.col("rank").cast("int")).alias("group_id"), "first", "n")


def publish_gate(spark, d):
    """Records that can be published: complete, in a lane, with a body and in scope."""
    s = table(spark, d, "source_record").select("capture_id", F.lower(F.trim("ingest_status")).alias("st"), "material_lane", F.col("content.plain_text").alias("t"), F.col("source.scope_status").alias("scope")).distinct()
    ok = (F.col("st") == "complete") & F.col("material_lane").isin("rule", "reference") & ~T.blank(F.col("t")) & (F.coalesce("scope", F.lit("matched")) == "matched")
    return s.groupBy("material_lane").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("passed"))


def term_match(spark, d):
    """Query terms in titles, per document those that match."""
    terms = F.array(*(F.lit(t) for t in ("evaluation", "collateral", "margin", "基金", "投顾", "托管")))
    x = table(spark, d, "documents").select("doc_id", F.lower("title").alias("t"))
    return x.select("doc_id", F.array_join(F.filter(terms, lambda k: F.contains(F.col("t"), k)), ",").alias("terms")).where("terms <> ''")


def title_rules(spark, d):
    """Kind of each record by the first rule its title meets, with the reasons for a review."""
    n = F.lower("name")
    kind = decide([Rule("notice", n.rlike("的(通知|公告)$|^notice"), "notice", 0.95), Rule("draft", n.rlike(T.DRAFT), "draft", 0.99), Rule("rule", n.rlike("办法|规定|准则|细则|指引|规则|规程|measures|rules|provisions|guidelines"), "rule", 0.85)], Rule("other", F.lit(True), "other", 0.55))
    c = _captures(spark, d).where("name is not null").withColumn("k", kind)
    why = reasons({"unsure": F.col("k.confidence") < 0.9, "no_number": T.fileno_key(F.col("fileno")).isNull(), "no_day": lenient_date(F.col("pub_date")).isNull()})
    return c.groupBy(F.col("k.outcome").alias("kind"), F.col("k.rule_id").alias("rule_id"), F.array_join(why, ",").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


def snapshot_changes(spark, d):
    """What changed between the first and the last capture of each source record."""
    c = _captures(spark, d).select("source_record_id", "capture_id", "fetched_at", T.body_hash(F.col("body"), 1).alias("c"), F.concat_ws("|", "name", "fileno", "pub_date").alias("m"))
    key = lambda f: c.groupBy("source_record_id").agg(f(F.struct("fetched_at", "capture_id", "c", "m")).alias("x")).select("source_record_id", "x.c", "x.m")
    return changes.snapshot_diff(key(F.min), key(F.max), "source_record_id", "c", "m")


def removal_events(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("ts").cast("date").alias("run")).distinct()
    return changes.removal_events(e, e.select("run").distinct(), "key", "run")


def integrity(spark, d):
    """Issues over the tables, counted by check."""
    m = table(spark, d, "source_map").distinct()
    law = table(spark, d, "law_document").select("law_id", F.col("metadata.name").alias("name"), "full_text").distinct()
    s = table(spark, d, "source_record").select("capture_id", F.lower(F.trim("ingest_status")).alias("st"), F.col("source_record_id").alias("record_id")).distinct()
    writ = table(spark, d, "writ_document").select(F.explode("legal_basis").alias("b")).select(F.col("b.law_id").alias("law_id"))
    found = [
        quality.unique(m.select(F.concat_ws(":", "source_system", "record_id").alias("k")), "k", "map_key_unique"),
        quality.foreign(s, "record_id", m, "record_id", "record_mapped"),
        quality.foreign(writ, "law_id", law, "law_id", "cited_law_known"),
        quality.required(law, "law_id", ["name", "full_text"], "law_complete"),
        quality.allowed(s, "capture_id", "st", ["complete", "incomplete", "failed"], "status_known"),
    ]
    issues = found[0]
    for f in found[1:]:
        issues = issues.unionAll(f)
    return issues.groupBy("check_id").agg(F.count(F.lit(1)).alias("issues"))


def ratio_report(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.try_divide(F.sum(F.col("l_extendedprice") * F.col("l_discount")), F.nullif(F.sum("l_extendedprice"), F.lit(0.0))), 6).alias("discount_share"))


def common_brands(spark, d):
    """Per nation and day with several orders, the brands that all its orders hold."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("day"), "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    rows = l.join(p, "l_partkey").join(o.join(c, "o_custkey"), "l_orderkey").select("nation", "day", "l_orderkey", "brand")
    return resolve.common_to_all(rows, ["nation", "day"], "l_orderkey", "brand").where("members > 1")


_C = "c AS MATERIALIZED (SELECT DISTINCT capture_id, source_record_id, replace(lower(trim(source_system)), '-', '_') AS system, struct_extract(metadata, 'name') AS name, struct_extract(metadata, 'fileno') AS fileno, struct_extract(metadata, 'pub_date') AS pub_date, struct_extract(metadata, 'pub_org') AS pub_org, struct_extract(content, 'plain_text') AS body, list_transform(assets, lambda a: a.asset_id) AS ids, fetched_at FROM source_record)"
_WS = T.SPACE
_AUDIT = f"""{_C}, x AS (SELECT *, {_NT('name')} AS title, CASE WHEN length(regexp_replace(body, '[{_WS}]+', '', 'g')) >= 80 THEN sha256(regexp_replace(body, '[{_WS}]+', '', 'g')) END AS hash, {_FN('fileno')} AS number, {_LD('pub_date')} AS day FROM c),
k AS (SELECT 'title' AS kind, title AS key, * FROM x UNION ALL SELECT 'body', hash, * FROM x),
g AS (SELECT kind, sha256(key) AS key_hash, count(*) AS size, CASE WHEN count(DISTINCT number) = 1 OR count(DISTINCT day) = 1 OR max(length(body)) - min(length(body)) <= 0.05 * max(length(body)) THEN 'high' ELSE 'medium' END AS severity, CASE WHEN count(DISTINCT source_record_id) = 1 THEN 'recaptured' ELSE 'across_records' END AS role FROM k WHERE key <> '' GROUP BY kind, key HAVING count(*) > 1)"""
_KNOWN = lambda c: f"nullif(nullif(trim({c}), ''), 'unknown')"

QUERIES = {
    "dup_audit": dup_audit, "dedupe_plan": dedupe_plan, "merge_fold": merge_fold, "anchor_dedupe": anchors, "completeness": completeness, "asset_merge": asset_merge, "asset_status": asset_status,
    "series_gaps": series_gaps, "subject_seeds": subject_seeds, "law_citations": law_citations, "candidate_evidence": candidate_evidence, "version_edges": version_edges, "run_islands": run_islands,
    "file_names": file_names, "latest_capture": latest_capture, "group_ordinals": group_ordinals, "publish_gate": publish_gate, "term_match": term_match, "title_rules": title_rules,
    "snapshot_changes": snapshot_changes, "removal_events": removal_events, "integrity_issues": integrity, "ratio_report": ratio_report, "common_brands": common_brands,
}
SQL = {
    "dup_audit": f"WITH {_AUDIT} SELECT * FROM g",
    "dedupe_plan": f"WITH {_AUDIT}, p AS (SELECT *, CASE WHEN role = 'recaptured' THEN 'auto_merge' WHEN kind = 'body' THEN 'merge' WHEN severity = 'high' THEN 'review' ELSE 'keep' END AS plan, CASE WHEN role = 'recaptured' THEN 'same_record' WHEN kind = 'body' THEN 'same_body' WHEN severity = 'high' THEN 'high_title' ELSE 'other' END AS rule_id FROM g) SELECT kind, severity, plan, rule_id, count(*) AS groups, CAST(sum(size) AS BIGINT) AS records FROM p GROUP BY ALL",
    "merge_fold": f"WITH {_C} SELECT source_record_id, count(*) AS merged, " + ", ".join(f"arg_min({_KNOWN(k)}, (capture_id, {_KNOWN(k)})) FILTER ({_KNOWN(k)} IS NOT NULL) AS {k}" for k in ("name", "fileno", "pub_date", "pub_org")) + f", max(length(body)) FILTER ({_KNOWN('body')} IS NOT NULL) AS body_length, array_to_string(list_sort(list_distinct(flatten(list(coalesce(ids, []))))), ',') AS asset_ids FROM c GROUP BY 1",
    "anchor_dedupe": "WITH RECURSIVE o AS (SELECT o_custkey AS c, o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day, min(o_orderkey) AS first FROM orders GROUP BY ALL), a AS (SELECT c, p, min(day) AS at FROM o GROUP BY ALL UNION ALL SELECT a.c, a.p, (SELECT min(o.day) FROM o WHERE o.c = a.c AND o.p = a.p AND o.day > a.at + 3) FROM a WHERE a.at IS NOT NULL), f AS (SELECT a.c, a.p, a.at, o.first AS anchor FROM a JOIN o ON o.c = a.c AND o.p = a.p AND o.day = a.at) SELECT r.o_orderkey, f.anchor AS anchor_id FROM orders r JOIN f ON f.c = r.o_custkey AND f.p = r.o_orderpriority AND CAST(r.o_orderdate AS DATE) BETWEEN f.at AND f.at + 3 WHERE f.anchor <> r.o_orderkey",
    "completeness": f"WITH {_C} SELECT capture_id, " + " + ".join(f"CAST(coalesce(nullif(trim({k}), 'unknown'), '') <> '' AS INTEGER)" for k in ("name", "fileno", "pub_date", "pub_org")) + " AS score FROM c",
    "asset_merge": "WITH a AS (SELECT DISTINCT * FROM asset_record), k AS (SELECT *, regexp_extract(lower(trim(sha256)), '^(?:sha-?256[:=])?([0-9a-f]{64})$', 1) AS sha FROM a) SELECT CASE WHEN sha <> '' THEN 'sha:' || sha WHEN local_file <> '' THEN 'file:' || local_file ELSE 'url:' || source_url END AS key, count(DISTINCT asset_id) AS assets, min(asset_id) AS first_asset, coalesce(array_to_string(list_sort(list(DISTINCT kind) FILTER (kind IS NOT NULL)), ','), '') AS kinds FROM k GROUP BY 1",
    "asset_status": "WITH a AS (SELECT DISTINCT * FROM asset_record) SELECT kind, count(*) AS n, count(*) FILTER (download_status = 'downloaded') AS downloaded, count(*) FILTER (size_bytes = 0) AS empty, round(count(*) FILTER (download_status = 'downloaded') / count(*), 6) AS share, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS bytes FROM a GROUP BY 1",
    "series_gaps": f"WITH l AS MATERIALIZED (SELECT struct_extract(struct_extract(lawlist, 'law'), 'fileno') AS fileno FROM law_detail), k AS (SELECT {_FN('fileno')} AS k FROM l), s AS (SELECT DISTINCT regexp_extract(k, '^(\\p{{L}}+(?:19|20)\\d{{2}})(\\d+)$', 1) AS series, CAST(regexp_extract(k, '^(\\p{{L}}+(?:19|20)\\d{{2}})(\\d+)$', 2) AS INTEGER) AS no FROM k WHERE k IS NOT NULL), n AS (SELECT series, no, lead(no) OVER (PARTITION BY series ORDER BY no) AS nx FROM s) SELECT series, no + 1 AS first_missing, nx - 1 AS last_missing FROM n WHERE nx > no + 1",
    "subject_seeds": "WITH u AS MATERIALIZED (SELECT writ_id, unnest(parties) AS p FROM writ_document), p AS MATERIALIZED (SELECT DISTINCT writ_id, struct_extract(p, 'party_type') AS party_type, struct_extract(p, 'name') AS name FROM u), g AS (SELECT party_type, lower(regexp_replace(name, '[^\\p{L}\\p{N}]', '', 'g')) AS norm, count(DISTINCT writ_id) AS writs, min(name) AS name FROM p WHERE length(trim(name)) > 0 GROUP BY 1, 2) SELECT 'subject_' || substr(sha256(concat_ws(':', party_type, norm)), 1, 24) AS seed_id, party_type, name, writs FROM g",
    "law_citations": "WITH u AS MATERIALIZED (SELECT writ_id, unnest(legal_basis) AS b FROM writ_document), c AS MATERIALIZED (SELECT DISTINCT writ_id, struct_extract(b, 'law_id') AS law_id, struct_extract(b, 'entry_title') AS entry_title FROM u) SELECT law_id, count(*) AS citations, count(DISTINCT writ_id) AS writs FROM c GROUP BY 1",
    "version_edges": "WITH l AS MATERIALIZED (SELECT struct_extract(lawlist, 'law') AS w FROM law_detail), v AS (SELECT DISTINCT w.lawPubOrgName AS org, w.secFutrsLawId AS id, try_cast(nullif(regexp_replace(w.secFutrsLawVersion, '[^0-9]', '', 'g'), '') AS BIGINT) AS v FROM l), n AS (SELECT org, id, v, lead(id) OVER o AS older, lead(v) OVER o AS ov FROM v WHERE v > 0 AND org IS NOT NULL WINDOW o AS (PARTITION BY org ORDER BY v DESC, id)) SELECT org, id AS from_id, older AS to_id FROM n WHERE ov < v",
    "run_islands": "WITH e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) - DATE '2000-01-01' AS day FROM events), i AS (SELECT user_id, day, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS g FROM e) SELECT user_id, min(day) AS first, max(day) AS last, count(*) AS length FROM i GROUP BY user_id, g HAVING count(*) >= 3",
    "file_names": f"WITH s AS (SELECT doc_id, coalesce({_NT('title')}, 'untitled') AS stem FROM documents), n AS (SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY stem ORDER BY doc_id) = 1 THEN stem ELSE stem || ' - ' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) END AS name FROM s) SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY name ORDER BY doc_id) = 1 THEN name ELSE name || '-' || row_number() OVER (PARTITION BY name ORDER BY doc_id) END AS file_name FROM n",
    "latest_capture": f"WITH {_C} SELECT source_record_id, arg_max(capture_id, (fetched_at, capture_id)) AS capture_id, arg_max(system, (fetched_at, capture_id)) AS system FROM c GROUP BY 1",
    "group_ordinals": f"WITH t AS (SELECT doc_id, {_LD('pub_date')} AS day FROM documents), g AS (SELECT day, min(doc_id) AS first, count(*) AS n FROM t WHERE day IS NOT NULL GROUP BY 1 HAVING count(*) > 1) SELECT printf('day:%04d', row_number() OVER (ORDER BY first)) AS group_id, first, n FROM g",
    "publish_gate": f"WITH s AS MATERIALIZED (SELECT DISTINCT capture_id, lower(trim(ingest_status)) AS st, material_lane, struct_extract(content, 'plain_text') AS t, struct_extract(source, 'scope_status') AS scope FROM source_record) SELECT material_lane, count(*) AS n, count(*) FILTER (st = 'complete' AND material_lane IN ('rule', 'reference') AND t IS NOT NULL AND length(regexp_replace(t, '[{_WS}]+', '', 'g')) > 0 AND coalesce(scope, 'matched') = 'matched') AS passed FROM s GROUP BY 1",
    "term_match": "WITH t AS (SELECT doc_id, array_to_string(list_filter(['evaluation', 'collateral', 'margin', '基金', '投顾', '托管'], lambda k: contains(lower(title), k)), ',') AS terms FROM documents WHERE title IS NOT NULL) SELECT * FROM t WHERE terms <> ''",
    "title_rules": f"WITH {_C}, k AS (SELECT CASE WHEN regexp_matches(lower(name), '的(通知|公告)$|^notice') THEN 'notice' WHEN regexp_matches(lower(name), '{T.DRAFT}') THEN 'draft' WHEN regexp_matches(lower(name), '办法|规定|准则|细则|指引|规则|规程|measures|rules|provisions|guidelines') THEN 'rule' ELSE 'other' END AS kind, {_FN('fileno')} AS number, {_LD('pub_date')} AS day FROM c WHERE name IS NOT NULL) SELECT kind, kind AS rule_id, coalesce(array_to_string(list_filter([CASE WHEN kind IN ('rule', 'other') THEN 'unsure' END, CASE WHEN number IS NULL THEN 'no_number' END, CASE WHEN day IS NULL THEN 'no_day' END], lambda r: r IS NOT NULL), ','), '') AS reasons, count(*) AS n FROM k GROUP BY ALL",
    "snapshot_changes": f"WITH {_C}, h AS (SELECT source_record_id, capture_id, fetched_at, CASE WHEN length(regexp_replace(body, '[{_WS}]+', '', 'g')) >= 1 THEN sha256(regexp_replace(body, '[{_WS}]+', '', 'g')) END AS b, concat_ws('|', name, fileno, pub_date) AS m FROM c), w AS (SELECT source_record_id, first_value(b) OVER o AS b0, first_value(m) OVER o AS m0, last_value(b) OVER o AS b1, last_value(m) OVER o AS m1 FROM h WINDOW o AS (PARTITION BY source_record_id ORDER BY fetched_at, capture_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) SELECT DISTINCT source_record_id, CASE WHEN b0 IS DISTINCT FROM b1 THEN 'content_changed' ELSE 'metadata_changed' END AS change FROM w WHERE b0 IS DISTINCT FROM b1 OR m0 <> m1",
    "removal_events": "WITH e AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS key, CAST(ts AS DATE) AS run FROM events), r AS (SELECT run, row_number() OVER (ORDER BY run) AS n FROM (SELECT DISTINCT run FROM e)), g AS (SELECT k.key, r.run, r.n, e.run IS NOT NULL AS seen FROM (SELECT DISTINCT key FROM e) k CROSS JOIN r LEFT JOIN e ON e.key = k.key AND e.run = r.run), m AS (SELECT *, n - max(n) FILTER (seen) OVER (PARTITION BY key ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS since FROM g) SELECT key, run, CASE WHEN seen THEN 'restored' ELSE 'removed' END AS event FROM m WHERE (NOT seen AND since = 2) OR (seen AND since > 2)",
    "ratio_report": "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * l_discount) / nullif(sum(l_extendedprice), 0), 6) AS discount_share FROM lineitem GROUP BY 1, 2",
    "candidate_evidence": f"WITH s AS (SELECT {_CU("struct_extract(source, 'page_url')")} AS url, capture_id, web_category_leaf AS leaf FROM source_record) SELECT url, min(capture_id) AS first_capture, coalesce(string_agg(DISTINCT leaf, ',' ORDER BY leaf), '') AS leaves FROM s GROUP BY 1",
    "integrity_issues": "WITH l AS MATERIALIZED (SELECT DISTINCT law_id, struct_extract(metadata, 'name') AS name, full_text FROM law_document), s AS MATERIALIZED (SELECT DISTINCT capture_id, lower(trim(ingest_status)) AS st, source_record_id FROM source_record), w AS (SELECT DISTINCT b.law_id AS law_id FROM (SELECT unnest(legal_basis) AS b FROM writ_document)), i AS (SELECT 'map_key_unique' AS check_id FROM (SELECT DISTINCT * FROM source_map) GROUP BY source_system, record_id HAVING count(*) > 1 UNION ALL SELECT 'record_mapped' FROM (SELECT DISTINCT source_record_id AS r FROM s) WHERE r NOT IN (SELECT record_id FROM source_map) UNION ALL SELECT 'cited_law_known' FROM w WHERE law_id NOT IN (SELECT law_id FROM l) UNION ALL SELECT 'law_complete' FROM l WHERE trim(coalesce(name, '')) = '' OR trim(coalesce(full_text, '')) = '' UNION ALL SELECT 'status_known' FROM s WHERE st NOT IN ('complete', 'incomplete', 'failed')) SELECT check_id, count(*) AS issues FROM i GROUP BY 1",
    "common_brands": "WITH x AS MATERIALIZED (SELECT c_nationkey AS nation, o_orderdate AS day, l_orderkey, list_distinct(list(p_brand)) AS brands FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY ALL), g AS (SELECT nation, day, count(*) AS members, list_reduce(list(brands), lambda a, b: list_intersect(a, b)) AS shared FROM x GROUP BY ALL HAVING count(*) > 1) SELECT nation, day, members, unnest(shared) AS brand FROM g",
}
