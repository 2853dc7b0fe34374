"""Queries over links, systems and orders: joins, graphs, mirrors, inventories (JN, AGG-01..12, SET)."""

from __future__ import annotations

from pyspark.sql import functions as F

from canonry.functions import text as T
from canonry.functions.dates import china_date, lenient_date
from canonry.functions.ids import family_id
from canonry.operators import graph, joins, quality
from canonry.session import cut, table

#: Which family of an edge comes first where several give the same one.
FAMILIES = {"curated": 0, "neris_revision": 1, "catalog_inference": 2}


def edges(spark, d):
    """Distinct usable edges with cleaned ids and relation names."""
    trim = lambda c: F.nullif(F.lower(F.regexp_replace(c, f"^[{T.SPACE}]+|[{T.SPACE}]+$", "")), F.lit(""))
    r = table(spark, d, "catalog_relation").select(trim("from_id").alias("from_id"), trim("to_id").alias("to_id"), trim("relation").alias("relation"), "source", "confidence")
    return r.where("from_id <> to_id and relation is not null").distinct()


_EDGES = "e AS MATERIALIZED (SELECT DISTINCT f AS from_id, t AS to_id, r AS relation, source, confidence FROM (SELECT nullif(lower(trim(from_id, ' ' || chr(9) || chr(10) || chr(13))), '') AS f, nullif(lower(trim(to_id, ' ' || chr(9) || chr(10) || chr(13))), '') AS t, nullif(lower(trim(relation, ' ' || chr(9) || chr(10) || chr(13))), '') AS r, source, confidence FROM catalog_relation) WHERE f <> t AND r IS NOT NULL)"


def edge_union(spark, d):
    rank = F.create_map(*(F.lit(x) for kv in FAMILIES.items() for x in kv))
    order = [F.coalesce(rank[F.col("source")], F.lit(9)), -F.coalesce("confidence", F.lit(0.0))]
    return joins.first_wins(edges(spark, d).select("from_id", "to_id", "relation", F.coalesce("source", F.lit("")).alias("source"), "confidence"), ["from_id", "to_id", "relation"], order)


def copy_suppressed(spark, d):
    e = edges(spark, d).select("from_id", "to_id", "relation").distinct()
    pair = lambda df: df.select("from_id", "to_id", "relation", F.least("from_id", "to_id").alias("a"), F.greatest("from_id", "to_id").alias("b"))
    newer = pair(e.where("relation = 'supersedes'")).select("a", "b").distinct()
    return pair(e.where("relation = 'same_instrument_copy'")).join(newer, ["a", "b"], "left_anti").select("from_id", "to_id")


def mirror_check(spark, d):
    """Per relation: stored references, and those whose other side isn't stored as well."""
    e = edges(spark, d).select("from_id", "to_id", "relation").distinct()
    lacking = quality.unmirrored(e, e.select(F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"), "relation"), ["from_id", "to_id", "relation"])
    missing = lacking.where("side = 'missing'").groupBy("relation").agg(F.count(F.lit(1)).alias("missing"))
    return e.groupBy("relation").agg(F.count(F.lit(1)).alias("refs")).join(missing, "relation", "left").select("relation", "refs", F.coalesce("missing", F.lit(0)).alias("missing"))


def mirror_index(spark, d):
    return graph.mirror(edges(spark, d).select("from_id", "to_id", "relation").distinct()).groupBy("node", "direction", "relation").agg(F.count(F.lit(1)).alias("n"), F.min("counterpart").alias("first_counterpart"))


def degree_pivot(spark, d):
    m = graph.mirror(edges(spark, d).select("from_id", "to_id", "relation").distinct())
    kinds = ["cited_by_case", "related_to", "supersedes", "publishes", "finalizes_draft", "same_instrument_copy"]
    return m.groupBy("node").agg(F.count(F.lit(1)).alias("degree"), *(F.count_if(F.col("relation") == k).alias(k) for k in kinds))


def degree_top(spark, d):
    m = graph.mirror(edges(spark, d).select("from_id", "to_id", "relation").distinct())
    return m.groupBy("node").agg(F.count(F.lit(1)).alias("degree")).orderBy(F.desc("degree"), "node").limit(20)


def version_families(spark, d):
    e = edges(spark, d).where("relation in ('supersedes', 'finalizes_draft')").select(F.col("from_id").alias("a"), F.col("to_id").alias("b")).distinct()
    return graph.components(e).select(F.col("node").alias("entity_id"), F.col("component").alias("family"))


def copy_consensus(spark, d):
    """Per group of copies the cited cases: inherited where exactly one value is known."""
    e = edges(spark, d).select("from_id", "to_id", "relation").distinct()
    groups = graph.components(e.where("relation = 'same_instrument_copy'").select(F.col("from_id").alias("a"), F.col("to_id").alias("b")))
    facts = e.where("relation = 'publishes'").select(F.col("from_id").alias("node"), F.col("to_id").alias("value")).distinct()
    # Of a value only its least and greatest count: one value where they are equal.
    per = groups.join(facts, "node").groupBy("component").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    return sizes.join(per, "component", "left").select("component", "members", F.when(F.col("low") == F.col("high"), F.col("low")).alias("inherited"), F.coalesce(F.col("low") != F.col("high"), F.lit(False)).cast("int").alias("conflict"))


def stub_nodes(spark, d):
    nodes = table(spark, d, "source_map").select("entity_id")
    return joins.with_stubs(edges(spark, d), nodes, "to_id", "entity_id").groupBy("is_stub").agg(F.count(F.lit(1)).alias("n")).select(F.col("is_stub").cast("int").alias("is_stub"), "n")


def priority_match(spark, d):
    law = table(spark, d, "law_detail").select("lawlist.law.*").select(F.col("secFutrsLawId").alias("law_id"), T.normal_title(F.col("secFutrsLawName")).alias("key"), T.fileno_key(F.col("fileno")).alias("number"), china_date(F.col("pubDate")).alias("day")).distinct()
    probe = table(spark, d, "source_record").select("capture_id", T.normal_title(F.col("metadata.name")).alias("key"), T.fileno_key(F.col("metadata.fileno")).alias("number"), lenient_date(F.col("metadata.pub_date")).alias("day")).distinct()
    return joins.priority_match(probe, law.where("key <> ''"), "key", "number", "day", "law_id", "capture_id")


def match_counts(spark, d):
    return priority_match(spark, d).groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.count("match_id").alias("matched"))


def _orders(spark, d, status):
    return table(spark, d, "orders").where(F.col("o_orderstatus") == status)


def asof_forward(spark, d):
    left = _orders(spark, d, "P").select("o_orderkey", "o_custkey", "o_orderdate")
    return joins.as_of(left, _orders(spark, d, "F").select("o_custkey", F.col("o_orderdate").alias("t"), F.col("o_orderkey").alias("k")), ["o_custkey"], "o_orderdate", "t", "k").select("o_orderkey", "as_of_id")


def asof_backward(spark, d):
    left = _orders(spark, d, "O").select("o_orderkey", "o_custkey", "o_orderdate")
    return joins.as_of(left, _orders(spark, d, "F").select("o_custkey", F.col("o_orderdate").alias("t"), F.col("o_orderkey").alias("k")), ["o_custkey"], "o_orderdate", "t", "k", False, True).select("o_orderkey", "as_of_id")


def unique_final(spark, d):
    left = _orders(spark, d, "P").select(F.col("o_orderkey").alias("draft_id"), "o_custkey", "o_orderpriority", F.col("o_orderdate").alias("t"))
    right = _orders(spark, d, "F").select(F.col("o_orderkey").alias("final_id"), "o_custkey", "o_orderpriority", "o_orderdate")
    return joins.unique_later(left, right, ["o_custkey", "o_orderpriority"], "t", "o_orderdate", "draft_id", "final_id")


def same_number_classes(spark, d):
    """Records of one number and title key: one row each, with class and its number of links."""
    s = table(spark, d, "source_record").select("source_record_id", T.fileno_key(F.col("metadata.fileno")).alias("number"), F.explode(T.title_keys(F.col("metadata.name"))).alias("key")).where("number is not null").distinct()
    size = s.groupBy("number", "key").agg(F.count(F.lit(1)).alias("n"), F.min("source_record_id").alias("class_id")).where("n > 1")
    return s.join(size, ["number", "key"]).select("source_record_id", "number", "key", "class_id", (F.col("n") - 1).alias("links"))


def asset_inventory(spark, d):
    """Full outer inventory of asset rows and of assets that records name."""
    a = table(spark, d, "asset_record").groupBy("asset_id").agg(F.max(F.struct("updated_at", "download_status")).alias("x")).select("asset_id", F.col("x.download_status").alias("status"))
    n = table(spark, d, "source_record").select(F.explode("assets").alias("a")).select(F.col("a.asset_id").alias("asset_id")).where("asset_id is not null").groupBy("asset_id").agg(F.count(F.lit(1)).alias("mentions"))
    j = a.withColumn("has", F.lit(1)).join(n, "asset_id", "full_outer")
    seen = F.when(F.col("has").isNull(), "named_only").when(F.col("mentions").isNull(), "stored_only").otherwise("both")
    return j.groupBy(seen.alias("seen"), "status").agg(F.count(F.lit(1)).alias("n"))


def map_coverage(spark, d):
    """Per system: records, those without an entity, mapped records that are absent."""
    m = table(spark, d, "source_map").select(F.col("source_system").alias("system"), "record_id").distinct().withColumn("m", F.lit(1))
    r = table(spark, d, "source_record").select(T.canonical_system(F.col("source_system")).alias("system"), F.col("source_record_id").alias("record_id")).distinct().withColumn("r", F.lit(1))
    return m.join(r, ["system", "record_id"], "full_outer").groupBy("system").agg(F.count("r").alias("records"), F.count_if("m is null" if False else F.col("m").isNull()).alias("unmapped"), F.count_if(F.col("r").isNull()).alias("absent"))


def live_match(spark, d):
    """Documents matched to law texts by page address, else by title key (JN-21)."""
    law = table(spark, d, "law_document").select("law_id", T.canonical_url(F.col("source.page_url"), False).alias("url"), T.normal_title(F.col("metadata.name")).alias("title")).distinct()
    by_url = law.groupBy("url").agg(F.min("law_id").alias("url_match"))
    by_title = law.where("title <> ''").groupBy("title").agg(F.min("law_id").alias("title_match"))
    s = table(spark, d, "source_record").select("capture_id", T.canonical_url(F.col("source.page_url"), False).alias("url"), T.normal_title(F.col("metadata.name")).alias("title")).distinct()
    j = s.join(by_url, "url", "left").join(by_title, "title", "left")
    return j.select("capture_id", F.coalesce("url_match", "title_match").alias("law_id"), F.when(F.col("url_match").isNotNull(), "url").when(F.col("title_match").isNotNull(), "title").alias("by"))


_MARKS = T.SPACE + "·•,，。；;:：()（）\\[\\]【】《》“”\"''、—-"
_NT = lambda c: rf"lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '^[{T.SPACE}]+|[{T.SPACE}]+$', '', 'g'), '{T.ATTACHMENT}', ''), '{T.SUFFIX}', ''), '[{_MARKS}]+', '', 'g'))"
_NARROW = lambda c: f"translate({c}, '０１２３４５６７８９ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ［］（）．，：；！？－', '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz[]().,:;!?-')"
_BARE = lambda c: rf"regexp_replace(lower({_NARROW(c)}), '[第号年{T.PUNCT.replace(chr(39), chr(39) * 2)}]+', '', 'g')"
_FN = lambda c: rf"CASE WHEN regexp_matches({_BARE(c)}, '^\p{{L}}+(?:19|20)\d{{2}}\d+$') THEN {_BARE(c)} END"
_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _CU(c: str, query: bool = True) -> str:  # noqa: N802
    part = lambda i: f"regexp_extract({c}, '{_URL}', {i})"
    kept = f"array_to_string(list_filter(string_split({part(4)}, '&'), lambda k: k <> '' AND NOT regexp_matches(lower(k), '^(utm_[a-z]+|_|timestamp|spm|from|source)(=|$)')), '&')"
    path = f"regexp_replace({part(3)}, '/{{2,}}', '/', 'g')"
    bare = f"lower({part(1)}) || '://' || lower({part(2)}) || CASE WHEN {path} = '' THEN '/' ELSE {path} END"
    full = f"{bare} || CASE WHEN coalesce({kept}, '') = '' THEN '' ELSE '?' || {kept} END" if query else bare
    return f"CASE WHEN regexp_matches({c}, '{_URL}') THEN {full} ELSE {c} END"


_LD = lambda c: rf"CASE WHEN regexp_matches({c}, '^\s*\d{{8}}\s*$') OR regexp_matches({c}, '^\s*\d{{4}}\s*[-/.年]\s*\d{{1,2}}\s*[-/.月]\s*\d{{1,2}}\s*日?([\sT].*)?$') THEN try_cast(regexp_replace({c}, '^\s*(\d{{4}})\s*[-/.年]?\s*(\d{{1,2}})\s*[-/.月]?\s*(\d{{1,2}})\s*日?(?:[\sT].*)?$', '\1-\2-\3') AS DATE) END"
_TITLE = lambda c: rf"regexp_replace(regexp_replace(regexp_replace({c}, '^[{T.SPACE}]+|[{T.SPACE}]+$', '', 'g'), '{T.ATTACHMENT}', ''), '{T.SUFFIX}', '')"
_ASKED = lambda c: rf"regexp_replace(regexp_replace(lower({_TITLE(c)}), '[(（]?(?:{T.DRAFT})[)）]?', '', 'g'), '^(?:关于)?(?:公开征求意见|征求意见)(?:的)?(?:通知|公告)?', '')"
_KEYS = lambda c: rf"list_filter(list_distinct(list_transform(list_prepend({c}, regexp_extract_all({c}, '《([^《》]{{4,120}})》', 1)), lambda t: {_NT(_ASKED('t'))})), lambda t: t <> '')"
_DISTINCT = "d AS MATERIALIZED (SELECT DISTINCT from_id, to_id, relation FROM e), m AS (SELECT from_id AS node, 'outgoing' AS direction, relation, to_id AS counterpart FROM d UNION ALL SELECT to_id, 'incoming', relation, from_id FROM d)"
_LAW = "l AS MATERIALIZED (SELECT DISTINCT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawName') AS name, struct_extract(struct_extract(lawlist, 'law'), 'fileno') AS fileno, struct_extract(struct_extract(lawlist, 'law'), 'pubDate') AS ms FROM law_detail)"
_PROBE = "s AS MATERIALIZED (SELECT DISTINCT capture_id, source_record_id, struct_extract(metadata, 'name') AS name, struct_extract(metadata, 'fileno') AS fileno, struct_extract(metadata, 'pub_date') AS pub_date, struct_extract(source, 'page_url') AS page_url FROM source_record)"
_PRIORITY = f"""{_LAW}, {_PROBE},
a AS MATERIALIZED (SELECT law_id, {_NT('name')} AS key, {_FN('fileno')} AS number, DATE '1970-01-01' + CAST(floor((ms + 28800000) / 86400000.0) AS INTEGER) AS day FROM l),
b AS MATERIALIZED (SELECT DISTINCT capture_id, {_NT('name')} AS key, {_FN('fileno')} AS number, {_LD('pub_date')} AS day FROM s),
j AS (SELECT b.capture_id, a.law_id, a.number = b.number AS same, abs(a.day - b.day) AS apart FROM b LEFT JOIN a ON a.key = b.key AND a.key <> ''),
g AS (SELECT capture_id, count(law_id) AS c, count(*) FILTER (same) AS n, min(law_id) FILTER (same) AS same_id, arg_min(law_id, (apart, law_id)) FILTER (apart <= 3) AS near, min(law_id) AS only_id FROM j GROUP BY 1),
r AS (SELECT *, CASE WHEN c = 0 THEN 'new' WHEN n = 1 THEN 'same' WHEN near IS NOT NULL THEN 'near_date' WHEN c = 1 THEN 'only_candidate' ELSE 'ambiguous' END AS rule FROM g),
p AS (SELECT capture_id, CASE rule WHEN 'same' THEN same_id WHEN 'near_date' THEN near WHEN 'only_candidate' THEN only_id END AS match_id, rule, CASE rule WHEN 'near_date' THEN 0.99 WHEN 'only_candidate' THEN 0.92 WHEN 'ambiguous' THEN 0.4 ELSE 1.0 END AS confidence FROM r)"""

QUERIES = {
    "edge_union_first_wins": edge_union, "copy_suppressed": copy_suppressed, "mirror_check": mirror_check, "mirror_index": mirror_index, "degree_pivot": degree_pivot, "degree_top": degree_top,
    "version_families": version_families, "copy_consensus": copy_consensus, "stub_nodes": stub_nodes, "priority_match": priority_match, "match_counts": match_counts,
    "asof_forward": asof_forward, "asof_backward_unique": asof_backward, "unique_final": unique_final, "same_number_classes": same_number_classes,
    "asset_inventory": asset_inventory, "map_coverage": map_coverage, "live_match": live_match,
}
SQL = {
    "edge_union_first_wins": f"WITH {_EDGES} SELECT from_id, to_id, relation, arg_min(coalesce(source, ''), (CASE source WHEN 'curated' THEN 0 WHEN 'neris_revision' THEN 1 WHEN 'catalog_inference' THEN 2 ELSE 9 END, -coalesce(confidence, 0), coalesce(source, ''))) AS source, arg_min(confidence, (CASE source WHEN 'curated' THEN 0 WHEN 'neris_revision' THEN 1 WHEN 'catalog_inference' THEN 2 ELSE 9 END, -coalesce(confidence, 0), coalesce(source, ''))) AS confidence FROM e GROUP BY ALL",
    "copy_suppressed": f"WITH {_EDGES}, d AS (SELECT DISTINCT from_id, to_id, relation FROM e) SELECT from_id, to_id FROM d WHERE relation = 'same_instrument_copy' AND NOT EXISTS (SELECT 1 FROM d s WHERE s.relation = 'supersedes' AND ((s.from_id = d.from_id AND s.to_id = d.to_id) OR (s.from_id = d.to_id AND s.to_id = d.from_id)))",
    "mirror_check": f"WITH {_EDGES}, d AS MATERIALIZED (SELECT DISTINCT from_id, to_id, relation FROM e) SELECT d.relation, count(*) AS refs, count(*) FILTER (b.from_id IS NULL) AS missing FROM d LEFT JOIN d b ON b.from_id = d.to_id AND b.to_id = d.from_id AND b.relation = d.relation GROUP BY 1",
    "mirror_index": f"WITH {_EDGES}, {_DISTINCT} SELECT node, direction, relation, count(*) AS n, min(counterpart) AS first_counterpart FROM m GROUP BY ALL",
    "degree_pivot": f"WITH {_EDGES}, {_DISTINCT} SELECT node, count(*) AS degree, " + ", ".join(f"count(*) FILTER (relation = '{k}') AS {k}" for k in ("cited_by_case", "related_to", "supersedes", "publishes", "finalizes_draft", "same_instrument_copy")) + " FROM m GROUP BY node",
    "degree_top": f"WITH {_EDGES}, {_DISTINCT} SELECT node, count(*) AS degree FROM m GROUP BY node ORDER BY degree DESC, node LIMIT 20",
    "version_families": f"WITH RECURSIVE {_EDGES}, b AS (SELECT from_id AS a, to_id AS b FROM e WHERE relation IN ('supersedes', 'finalizes_draft') UNION SELECT to_id, from_id FROM e WHERE relation IN ('supersedes', 'finalizes_draft')), r AS (SELECT a AS entity_id, a AS reached FROM b UNION SELECT r.entity_id, b.b FROM r JOIN b ON r.reached = b.a) SELECT entity_id, min(reached) AS family FROM r GROUP BY entity_id",
    "copy_consensus": f"WITH RECURSIVE {_EDGES}, b AS (SELECT from_id AS a, to_id AS b FROM e WHERE relation = 'same_instrument_copy' UNION SELECT to_id, from_id FROM e WHERE relation = 'same_instrument_copy'), r AS (SELECT a AS node, a AS reached FROM b UNION SELECT r.node, b.b FROM r JOIN b ON r.reached = b.a), g AS (SELECT node, min(reached) AS component FROM r GROUP BY node), v AS (SELECT component, count(DISTINCT e.to_id) AS k, min(e.to_id) AS v FROM g LEFT JOIN e ON e.from_id = g.node AND e.relation = 'publishes' GROUP BY 1) SELECT g.component, count(*) AS members, CASE WHEN any_value(v.k) = 1 THEN any_value(v.v) END AS inherited, CAST(any_value(v.k) > 1 AS INTEGER) AS conflict FROM g JOIN v USING (component) GROUP BY g.component",
    "stub_nodes": f"WITH {_EDGES} SELECT CAST(t.to_id NOT IN (SELECT entity_id FROM source_map) AS INTEGER) AS is_stub, count(*) AS n FROM (SELECT DISTINCT to_id FROM e) t GROUP BY 1",
    "priority_match": f"WITH {_PRIORITY} SELECT * FROM p",
    "match_counts": f"WITH {_PRIORITY} SELECT rule, count(*) AS n, count(match_id) AS matched FROM p GROUP BY rule",
    "asof_forward": "SELECT p.o_orderkey, (SELECT arg_min(f.o_orderkey, (f.o_orderdate, f.o_orderkey)) FROM orders f WHERE f.o_orderstatus = 'F' AND f.o_custkey = p.o_custkey AND f.o_orderdate > p.o_orderdate) AS as_of_id FROM orders p WHERE p.o_orderstatus = 'P'",
    "asof_backward_unique": "WITH n AS (SELECT p.o_orderkey, f.o_orderkey AS k, f.o_orderdate AS t, max(f.o_orderdate) OVER (PARTITION BY p.o_orderkey) AS last FROM orders p LEFT JOIN orders f ON f.o_orderstatus = 'F' AND f.o_custkey = p.o_custkey AND f.o_orderdate < p.o_orderdate WHERE p.o_orderstatus = 'O') SELECT o_orderkey, CASE WHEN count(*) FILTER (t = last) = 1 THEN min(k) FILTER (t = last) END AS as_of_id FROM n GROUP BY o_orderkey",
    "unique_final": "SELECT p.o_orderkey AS draft_id, min(f.o_orderkey) AS final_id FROM orders p JOIN orders f ON f.o_orderstatus = 'F' AND f.o_custkey = p.o_custkey AND f.o_orderpriority = p.o_orderpriority AND f.o_orderdate >= p.o_orderdate WHERE p.o_orderstatus = 'P' GROUP BY 1 HAVING count(*) = 1",
    "same_number_classes": f"WITH s AS MATERIALIZED (SELECT DISTINCT source_record_id, struct_extract(metadata, 'name') AS name, {_FN("struct_extract(metadata, 'fileno')")} AS number FROM source_record), w AS MATERIALIZED (SELECT DISTINCT source_record_id, number, unnest({_KEYS('name')}) AS key FROM s WHERE number IS NOT NULL AND name IS NOT NULL), g AS (SELECT number, key, min(source_record_id) AS class_id, count(*) - 1 AS links FROM w GROUP BY ALL HAVING count(*) > 1) SELECT w.source_record_id, number, key, class_id, links FROM w JOIN g USING (number, key)",
    "live_match": f"WITH l AS MATERIALIZED (SELECT DISTINCT law_id, {_CU("struct_extract(source, 'page_url')", False)} AS url, {_NT("struct_extract(metadata, 'name')")} AS title FROM law_document), s AS MATERIALIZED (SELECT DISTINCT capture_id, {_CU("struct_extract(source, 'page_url')", False)} AS url, {_NT("struct_extract(metadata, 'name')")} AS title FROM source_record), u AS (SELECT url, min(law_id) AS a FROM l GROUP BY 1), t AS (SELECT title, min(law_id) AS b FROM l WHERE title <> '' GROUP BY 1) SELECT capture_id, coalesce(a, b) AS law_id, CASE WHEN a IS NOT NULL THEN 'url' WHEN b IS NOT NULL THEN 'title' END AS by FROM s LEFT JOIN u ON u.url = s.url LEFT JOIN t ON t.title = s.title",
    "asset_inventory": "WITH a AS (SELECT asset_id, arg_max(download_status, updated_at) AS any_status FROM asset_record GROUP BY 1), l AS (SELECT asset_id, first(download_status ORDER BY updated_at DESC, download_status DESC NULLS LAST) AS status FROM asset_record GROUP BY 1), u AS (SELECT unnest(list_transform(assets, lambda x: x.asset_id)) AS asset_id FROM source_record), n AS (SELECT asset_id, count(*) AS mentions FROM u WHERE asset_id IS NOT NULL GROUP BY 1) SELECT CASE WHEN l.asset_id IS NULL THEN 'named_only' WHEN n.asset_id IS NULL THEN 'stored_only' ELSE 'both' END AS seen, status, count(*) AS n FROM l FULL JOIN n USING (asset_id) GROUP BY ALL",
    "map_coverage": "WITH m AS (SELECT DISTINCT source_system AS system, record_id FROM source_map), r AS (SELECT DISTINCT replace(lower(trim(source_system)), '-', '_') AS system, source_record_id AS record_id FROM source_record) SELECT coalesce(m.system, r.system) AS system, count(r.record_id) AS records, count(*) FILTER (m.record_id IS NULL) AS unmapped, count(*) FILTER (r.record_id IS NULL) AS absent FROM m FULL JOIN r ON m.system = r.system AND m.record_id = r.record_id GROUP BY 1",
}
