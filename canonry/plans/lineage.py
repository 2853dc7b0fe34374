"""Queries of state, attachments, clauses and contracts (STR, JN-04..26, AGG-02..22, VAL, SET, SRT, FIL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from canonry.functions import text as T
from canonry.functions.dates import lenient_date
from canonry.operators import attachments, clauses, joins, quality, resolve, state, windows
from canonry.plans.relations import _CU, _FN, _KEYS, _LD, _NT, edges
from canonry.session import table


_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _captures(spark, d):
    s = table(spark, d, "source_record")
    return s.select(
        "capture_id", "source_record_id", T.canonical_system(F.col("source_system")).alias("system"), F.col("metadata.name").alias("title"), F.col("metadata.pub_org").alias("org"), F.col("metadata.fileno").alias("fileno"),
        lenient_date(F.col("metadata.pub_date")).alias("day"), F.col("content.plain_text").alias("body"), "assets", "page_role", (F.lower(T.compact(F.col("ingest_status"))) == "complete").alias("ok"), "fetched_at",
        F.col("source.page_url").alias("page_url"), F.col("source.run_id").alias("run_id"), F.col("source.endpoint_id").alias("endpoint_id"), "schema_version", "material_lane",
    ).distinct()


def kept_attempts(spark, d):
    """STR-02: the capture that stands for each record."""
    c = _captures(spark, d).select("source_record_id", "capture_id", "ok", "fetched_at")
    return state.keep_last_good(c, "source_record_id", F.col("ok"), ["fetched_at", "capture_id"]).select("source_record_id", "capture_id", "is_complete")


def evidence(spark, d):
    """STR-07: endpoints and runs that saw each record, and the endpoint that saw it first."""
    c = _captures(spark, d).select("source_record_id", "fetched_at", "endpoint_id", "run_id", F.col("endpoint_id").alias("owner"))
    a = state.accumulated(c, "source_record_id", ["fetched_at"], ["endpoint_id", "run_id"], "owner")
    return a.select("source_record_id", "owner", F.array_join("endpoint_id", ",").alias("endpoints"), F.array_join("run_id", ",").alias("runs"))


def run_states(spark, d):
    """STR-08: completeness of each run over its captures; runs without a rule record publish nothing."""
    c = _captures(spark, d).where("run_id is not null")
    return state.run_status(c, "run_id", [F.col("ok"), F.col("title").isNotNull()], F.when(F.col("material_lane") == "rule", F.col("ok")))


def latest_runs(spark, d):
    """AGG-22: the last complete run of each system."""
    c = _captures(spark, d).groupBy("system", "run_id").agg(F.max("fetched_at").alias("seen_at"), F.bool_and("ok").alias("whole"))
    return state.latest_complete(c.where("system is not null"), "run_id", "seen_at", F.col("whole"), ["system"]).withColumn("seen_at", F.date_format("seen_at", _TIME))


def review_queue(spark, d):
    """STR-09, JN-24: captures without a number or title are queued, unless another capture of the record has a number, or they are supporting material."""
    c = _captures(spark, d)
    found = c.where("fileno is null").select("capture_id", "source_record_id", "fetched_at")
    queue = c.where("title is null").groupBy("capture_id").agg(F.min("fetched_at").alias("first_queued_at"), F.max("fetched_at").alias("last_queued_at"))
    numbered = c.where("fileno is not null").select("source_record_id")
    supporting = c.where("page_role = 'supporting_material'").select("capture_id")
    return state.queued(queue, found, [(numbered, "source_record_id"), (supporting, "capture_id")], "capture_id", "fetched_at").select("capture_id", *(F.date_format(t, _TIME).alias(t) for t in ("first_queued_at", "last_queued_at")))


def uncached_queries(spark, d):
    """STR-05: quarters of days that no document of the first half has, or whose document has no label."""
    day = lenient_date(F.col("pub_date"))
    docs = table(spark, d, "documents").select("doc_id", F.date_format(F.date_trunc("quarter", day), "yyyy-MM-dd").alias("quarter"), "lang").where("quarter is not null")
    finished = docs.where("lang = 'zh'").select("quarter", "doc_id")
    return state.uncached(docs.select("quarter").distinct(), finished, table(spark, d, "documents").where("title is not null"), "quarter", "doc_id")


def asset_states(spark, d):
    """JN-20: digest and file of the assets that records name: from the asset table, else as named; failed downloads override."""
    named = table(spark, d, "source_record").select(F.explode("assets").alias("a")).select(F.col("a.asset_id").alias("asset_id"), T.digest(F.col("a.sha256")).alias("digest"), F.col("a.local_file").alias("file")).where("asset_id is not null")
    last = windows.latest(table(spark, d, "asset_record").select("asset_id", "updated_at", T.digest(F.col("sha256")).alias("digest"), F.col("local_file").alias("file"), "download_status").where("asset_id is not null"), ["asset_id"], ["updated_at"])
    manifest = named.groupBy("asset_id").agg(F.min("digest").alias("digest"), F.min("file").alias("file"))
    failed = last.where("download_status = 'failed'").select("asset_id", F.lit(None).cast("string").alias("digest"), "file")
    return state.carried(named.select("asset_id").distinct(), "asset_id", [last, manifest], ["digest", "file"], failed)


def matched_either(spark, d):
    """JN-23: captures and laws equal in title or number, and in which."""
    c = _captures(spark, d).select("capture_id", T.normal_title(F.col("title")).alias("title"), T.fileno_key(F.col("fileno")).alias("number")).where("title is null or title <> ''")
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), T.normal_title(F.col("lawlist.law.secFutrsLawName")).alias("title"), T.fileno_key(F.col("lawlist.law.fileno")).alias("number")).distinct()
    return state.matched_either(c, law, "capture_id", "law_id", ["title", "number"])


def preferred_texts(spark, d):
    """JN-26: hash and origin of the text preferred for each law: the document's, else the closing text, else the opening one."""
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.col("lawlist.law.bodyAftCntnt").alias("after"), F.col("lawlist.law.bodyAgoCntnt").alias("ago")).where("law_id is not null")
    doc = table(spark, d, "law_document").select("law_id", "full_text")
    usable = lambda c: ~T.blank(F.col(c))
    p = state.preferred(law.select("law_id").distinct(), "law_id", [("document", doc, "full_text", usable("full_text")), ("after", law, "after", usable("after")), ("ago", law, "ago", usable("ago"))])
    return p.select("law_id", F.sha2("value", 256).alias("text_hash"), "origin")


def revision_refs(spark, d):
    """JN-25: what each entity revises: as curated, else as the revisions say, else as inferred."""
    e = edges(spark, d).where("relation = 'supersedes'").select(F.col("from_id").alias("entity_id"), "to_id", F.coalesce("source", F.lit("")).alias("source"))
    of = lambda s: (s, e.where(F.col("source") == s), "to_id", F.lit(True))
    return state.preferred(e.select("entity_id").distinct(), "entity_id", [of("curated"), of("neris_revision"), of("catalog_inference")])


def resumed_texts(spark, d):
    """STR-04, FIL-11: files whose text is still to be read."""
    todo = table(spark, d, "asset_record").where("download_status = 'downloaded' and local_file is not null").select("local_file").distinct()
    done = table(spark, d, "asset_text").where(~T.blank(F.col("plain_text"))).select("local_file")
    return state.resumed(todo, done, ["local_file"], {"mode": "full"}, {"mode": "full"})


def asset_refresh(spark, d):
    """FIL-15: assets to fetch again, and why: never fetched, empty, or a digest other than that named by a record."""
    named = table(spark, d, "source_record").select(F.explode("assets").alias("a")).select(F.col("a.asset_id").alias("asset_id"), T.digest(F.col("a.sha256")).alias("named")).dropna().groupBy("asset_id").agg(F.min("named").alias("named"), F.max("named").alias("other"))
    last = windows.latest(table(spark, d, "asset_record").select("asset_id", "updated_at", T.digest(F.col("sha256")).alias("digest"), "size_bytes", "download_status").where("asset_id is not null"), ["asset_id"], ["updated_at"])
    j = last.join(named, "asset_id", "left")
    differs = F.col("named").isNotNull() & F.col("digest").isNotNull() & (F.col("named") != F.col("digest")) & (F.col("other") != F.col("digest"))
    why = F.when(F.col("download_status").isNull() | F.col("download_status").isin("pending", "failed"), "not_fetched").when(F.coalesce("size_bytes", F.lit(0)) <= 0, "empty").when(differs, "digest")
    return j.select("asset_id", why.alias("reason")).where("reason is not null")


def page_carriers(spark, d):
    """JN-04: assets that are their page's document: the page's only one, its day and the same digest."""
    s = _captures(spark, d)
    parents = s.select("capture_id", "title", "day", F.transform("assets", lambda a: a["asset_id"]).alias("assets"), T.digest(F.element_at("assets", 1)["sha256"]).alias("digest")).where("size(assets) > 0")
    children = s.select("capture_id", "day", F.explode("assets").alias("a")).select(F.col("a.asset_id").alias("asset_id"), "capture_id", "day", T.digest(F.col("a.sha256")).alias("digest"))
    return attachments.carriers(children, parents, "asset_id", "capture_id", F.col("digest") == F.col("p_digest"), "送达公告|公告送达")


def citation_edges(spark, d):
    """JN-06: entities of decisions and of the laws they cite."""
    w = table(spark, d, "writ_document").select("writ_id", F.explode("legal_basis").alias("b")).select(F.lit("writ").alias("s0"), "writ_id", F.lit("neris").alias("s1"), F.col("b.law_id").alias("law_id"))
    return attachments.mapped_edges(w, table(spark, d, "source_map"), [(["s0", "writ_id"], "from_id"), (["s1", "law_id"], "to_id")], ["source_system", "record_id"], "entity_id")


def shared_announcements(spark, d):
    """AGG-04: laws that share one announcing text, here made of the publishing body, its titles and its day."""
    s = _captures(spark, d).where("org is not null and day is not null and title is not null").select("capture_id", "title", "org", "day")
    titles = s.select("org", "day", "title").distinct().groupBy("org", "day").agg(F.array_sort(F.collect_list("title")).alias("ts"))
    body = F.concat(F.col("org"), F.lit("现公布"), F.array_join(F.transform("ts", lambda t: F.concat(F.lit("《"), t, F.lit("》"))), "、"))
    docs = s.join(titles, ["org", "day"]).select("capture_id", "title", body.alias("body"))
    return attachments.shared_announcements(docs.withColumn("body_key", F.sha2("body", 256)), "capture_id", "title", "body", "body_key", "现公布|发布|印发")


def case_groups(spark, d):
    """AGG-08: entities of decisions, grouped by the links of copies between any entities named there."""
    e = edges(spark, d).where("relation = 'same_instrument_copy'").select(F.col("from_id").alias("a"), F.col("to_id").alias("b"))
    nodes = edges(spark, d).where("relation in ('same_instrument_copy', 'publishes')").select(F.explode(F.array("from_id", "to_id")).alias("node"))
    return attachments.case_groups(e, nodes, "node")


def dedupe_five(spark, d):
    """AGG-02: number and day, digests of cases, page address, body, digests of all assets, each within one title."""
    s = _captures(spark, d)
    shas = F.filter(F.transform("assets", lambda a: T.digest(a["sha256"])), lambda x: x.isNotNull())
    c = s.select(
        "capture_id", T.fileno_key(F.col("fileno")).alias("number"), "day", F.nullif(T.normal_title(F.col("title")), F.lit("")).alias("name"), F.when(F.col("material_lane") == "case", shas).alias("case_shas"),
        T.canonical_url(F.col("page_url")).alias("url"), T.body_hash(F.col("body")).alias("hash"), shas.alias("shas"), (-F.coalesce(F.length("body"), F.lit(0))).alias("shorter"),
    )
    return resolve.dedupe_passes(c, "capture_id", ["shorter"], [["number", "day", "name"], ["case_shas", "day"], ["url", "name"], ["hash", "name"], ["shas", "name"]])


def successors(spark, d):
    """JN-11: revised instruments and the older ones that a clause, made of their base titles, repeals."""
    s = _captures(spark, d).select("source_record_id", "title", "org", "day")
    one = s.groupBy("source_record_id").agg(F.min("title").alias("title"), F.min("org").alias("org"), F.min("day").alias("day"))
    base = clauses.base_title(F.col("title"))
    body = F.when(base != F.col("title"), F.concat(F.lit("本规则自发布之日起施行，《"), base, F.lit("》同时废止。")))
    return clauses.successors(one.select(F.col("source_record_id").alias("id"), "title", "org", "day", body.alias("body")))


def contract_issues(spark, d):
    """VAL-01: breaches of the contract of landed records, counted by check."""
    r = table(spark, d, "source_record").distinct()
    types = {"capture_id": "string", "source_record_id": "string", "schema_version": "int", "fetched_at": "timestamp_ntz", "landed_at": "timestamp_ntz"}
    types |= {k: v for k, v in r.dtypes if k in ("fetched_at", "landed_at")}
    i = quality.contract(r, "capture_id", types, ["capture_id", "source_record_id", "source_system", "ingest_status"], {"ingest_status": ["complete", "incomplete", "failed"], "material_lane": ["rule", "reference", "case", "unknown"]})
    return i.groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


def export_issues(spark, d):
    """VAL-03: contradictions between dates, status and texts of laws, and references of links to nothing."""
    law = table(spark, d, "law_detail").select("lawlist.law.*").distinct()
    c = quality.contradictions(
        law, "secFutrsLawId",
        {"effective_before_published": F.col("efctvDate") < F.col("pubDate"), "ended_before_effective": F.col("inefctvDate") < F.col("efctvDate"), "no_name": T.blank(F.col("secFutrsLawName")), "version_not_a_day": F.col("secFutrsLawVersion").isNotNull() & ~F.col("secFutrsLawVersion").rlike("^[0-9]{8}$")},
    )
    known = table(spark, d, "source_map").select(F.lower("entity_id").alias("entity_id"))
    f = quality.foreign(edges(spark, d), "to_id", known, "entity_id", "edge_to_unknown")
    return c.select("check_id").unionAll(f.select("check_id")).groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


def normalized_issues(spark, d):
    """VAL-06: empty texts, markup left, assets without a file, over the plain texts of captures."""
    c = _captures(spark, d).select("capture_id", "body", F.transform("assets", lambda a: a["local_file"]).alias("files"))
    f = table(spark, d, "asset_record").where("download_status = 'downloaded'")
    return quality.normalized(c, "capture_id", "body", "files", f, "local_file").groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


def enumerations(spark, d):
    """VAL-09: orders whose lines aren't numbered through, counted by check."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    n = l.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("reported"))
    i = quality.enumeration(l.where("l_suppkey % 7 <> 0").join(n, "l_orderkey"), "l_orderkey", "l_linenumber", "reported")
    return i.select("check_id", F.col("key").cast("bigint").alias("l_orderkey"))


def subset_issues(spark, d):
    """SET-04: systems that lack one of the lanes."""
    c = _captures(spark, d).where("system is not null").select("system", "run_id", "material_lane")
    return quality.subset(c.where("run_id is not null"), "run_id", "material_lane", ["rule", "reference", "case"], "lane_missing").select(F.col("key").alias("run_id"), F.col("detail").alias("lane"))


def registry_issues(spark, d):
    """VAL-08: endpoints at several systems, and addresses at several endpoints."""
    c = _captures(spark, d).select("endpoint_id", "system", T.canonical_url(F.col("page_url"), False).alias("url"))
    a = quality.unique(c.select("endpoint_id", "system").distinct(), "endpoint_id", "endpoint_of_systems")
    b = quality.unique(c.select("url", "endpoint_id").distinct(), "url", "address_of_endpoints")
    return a.unionAll(b).select("check_id", "key", F.col("detail").cast("bigint").alias("n"))


def cited_titles(spark, d):
    """JN-15: titles of cited laws: from their document, else their detail, else the clause cited."""
    w = table(spark, d, "writ_document").select(F.explode("legal_basis").alias("b")).select(F.col("b.law_id").alias("law_id"), F.col("b.entry_title").alias("entry")).where("law_id is not null")
    doc = table(spark, d, "law_document").select("law_id", F.col("metadata.name").alias("name"))
    law = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), F.col("lawlist.law.secFutrsLawName").alias("name"))
    p = state.preferred(w.select("law_id").distinct(), "law_id", [("document", doc, "name", ~T.blank(F.col("name"))), ("detail", law, "name", ~T.blank(F.col("name"))), ("citation", w, "entry", ~T.blank(F.col("entry")))])
    return p.select("law_id", F.col("value").alias("title"), "origin")


def merged_related(spark, d):
    """JN-19: related texts of each entity: those known, and citations not known yet."""
    known = edges(spark, d).where("relation = 'related_to'").select("from_id", "to_id").distinct().withColumn("origin", F.lit(0))
    new = citation_edges(spark, d).select(F.lower("from_id").alias("from_id"), F.lower("to_id").alias("to_id")).withColumn("origin", F.lit(1))
    return joins.first_wins(known.unionAll(new), ["from_id", "to_id"], [F.col("origin")])


def compact_nodes(spark, d):
    """FIL-13: ends of links with their kind and whether they have no name."""
    ends = edges(spark, d).select(F.explode(F.array("from_id", "to_id")).alias("node_id")).distinct()
    m = table(spark, d, "source_map").select(F.lower("entity_id").alias("node_id"), "source_system", "record_id")
    law = table(spark, d, "law_document").select(F.lit("neris").alias("source_system"), F.col("law_id").alias("record_id"), F.col("metadata.name").alias("name"))
    writ = table(spark, d, "writ_document").select(F.lit("writ").alias("source_system"), F.col("writ_id").alias("record_id"), F.col("metadata.name").alias("name"))
    named = m.join(law.unionAll(writ), ["source_system", "record_id"], "left").groupBy("node_id").agg(F.bool_or(F.col("source_system") == "writ").alias("w"), F.bool_or(F.col("source_system") == "neris").alias("l"), F.min("name").alias("name"))
    kind = F.when(F.col("w"), "writ").when(F.col("l"), "law").when(F.col("w").isNull(), "stub").otherwise("other")
    return ends.join(named, "node_id", "left").select("node_id", kind.alias("kind"), F.col("name").isNull().alias("nameless"))


def all_ids(spark, d):
    """SET-01: ids of laws from every table that has them, each once."""
    a = table(spark, d, "law_detail").select(F.col("lawlist.law.secFutrsLawId").alias("law_id"))
    b = table(spark, d, "law_document").select("law_id")
    c = table(spark, d, "writ_document").select(F.explode("legal_basis").alias("x")).select(F.col("x.law_id").alias("law_id"))
    return a.unionAll(b).unionAll(c).where("law_id is not null").distinct()


def ranked_documents(spark, d):
    """SRT-02: documents in the order of output, latest day first, numbered without a global task."""
    docs = table(spark, d, "documents").select("doc_id", lenient_date(F.col("pub_date")).alias("day"))
    order = docs.withColumn("o", -F.coalesce(F.unix_date("day"), F.lit(-1 << 30)))
    return windows.ranked(order, ["o", "doc_id"]).select("doc_id", "day", F.col("rank").alias("place"))


def sample_prefix(spark, d):
    """SRT-03: a sample for re-verification: the first 50 documents in the order of their hashes."""
    return table(spark, d, "documents").select("doc_id", F.sha2(F.col("doc_id").cast("string"), 256).alias("h")).orderBy("h").limit(50)


def sorted_refs(spark, d):
    """SRT-01: references of each node, sorted by relation, counterpart and direction."""
    e = edges(spark, d).where("relation in ('supersedes', 'finalizes_draft', 'publishes')").select("from_id", "to_id", "relation").distinct()
    refs = e.select(F.col("from_id").alias("node"), F.struct("relation", F.col("to_id").alias("other"), F.lit("out").alias("way")).alias("r")).unionAll(e.select(F.col("to_id").alias("node"), F.struct("relation", F.col("from_id").alias("other"), F.lit("in").alias("way")).alias("r")))
    g = refs.groupBy("node").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    return g.select("node", F.array_join(F.transform("rs", lambda r: F.concat_ws(":", r["relation"], r["other"], r["way"])), " ").alias("refs"))


_C = f"c AS MATERIALIZED (SELECT DISTINCT capture_id, source_record_id, replace(lower(trim(source_system)), '-', '_') AS system, struct_extract(metadata, 'name') AS title, struct_extract(metadata, 'pub_org') AS org, struct_extract(metadata, 'fileno') AS fileno, {_LD(chr(115) + 'truct_extract(metadata, ' + chr(39) + 'pub_date' + chr(39) + ')')} AS day, struct_extract(content, 'plain_text') AS body, assets, page_role, lower(trim(ingest_status)) = 'complete' AS ok, fetched_at, struct_extract(source, 'page_url') AS page_url, struct_extract(source, 'run_id') AS run_id, struct_extract(source, 'endpoint_id') AS endpoint_id, material_lane FROM source_record)"
_SHA = lambda x: f"CASE WHEN regexp_matches(regexp_replace(lower(regexp_replace({x}, '\\s+', '', 'g')), '^sha-?256[:=]', ''), '^[0-9a-f]{{64}}$') THEN regexp_replace(lower(regexp_replace({x}, '\\s+', '', 'g')), '^sha-?256[:=]', '') END"
_T = lambda c: f"nullif(lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13))), '')"
_E = f"e AS MATERIALIZED (SELECT DISTINCT f AS from_id, t AS to_id, r AS relation, source FROM (SELECT {_T('from_id')} AS f, {_T('to_id')} AS t, {_T('relation')} AS r, source FROM catalog_relation) WHERE f <> t AND r IS NOT NULL)"
_WS = T.SPACE
_LAST = f"last AS MATERIALIZED (SELECT asset_id, x.digest AS digest, x.file AS file, x.st AS st, x.size AS size FROM (SELECT asset_id, max({{'u': updated_at, 'digest': {_SHA('sha256')}, 'file': local_file, 'st': download_status, 'size': size_bytes}}) AS x FROM asset_record WHERE asset_id IS NOT NULL GROUP BY 1))"


def _five() -> str:
    """The five passes in SQL, each by closure over shared keys."""
    shas = f"list_filter(list_transform(assets, lambda a: {_SHA('a.sha256')}), lambda x: x IS NOT NULL)"
    parts = [
        _C,
        f"x0 AS MATERIALIZED (SELECT DISTINCT capture_id, {_FN('fileno')} AS number, day, nullif({_NT('title')}, '') AS name, CASE WHEN material_lane = 'case' THEN {shas} END AS case_shas, {_CU('page_url')} AS url, CASE WHEN length(regexp_replace(body, '[{_WS}]+', '', 'g')) >= 80 THEN sha256(regexp_replace(body, '[{_WS}]+', '', 'g')) END AS hash, {shas} AS shas, -coalesce(length(body), 0) AS shorter FROM c)",
    ]
    keys = ["number || '|' || day || '|' || name", "unnest(list_distinct(case_shas)) || '|' || day", "url || '|' || name", "hash || '|' || name", "unnest(list_distinct(shas)) || '|' || name"]
    for i, k in enumerate(keys):
        parts.append(f"g{i} AS MATERIALIZED (SELECT capture_id, k FROM (SELECT capture_id, {k} AS k FROM x{i}) WHERE k IS NOT NULL)")
        parts.append(f"l{i} AS MATERIALIZED (SELECT DISTINCT a.capture_id AS x, b.capture_id AS y FROM g{i} a JOIN g{i} b USING (k))")
        parts.append(f"r{i} AS (SELECT x, y FROM l{i} UNION SELECT r.x, l.y FROM r{i} r JOIN l{i} l ON r.y = l.x)")
        parts.append(f"m{i} AS MATERIALIZED (SELECT r.x AS capture_id, arg_min(r.y, (v.shorter, r.y)) AS kept FROM r{i} r JOIN x{i} v ON v.capture_id = r.y GROUP BY 1 HAVING arg_min(r.y, (v.shorter, r.y)) <> r.x)")
        parts.append(f"x{i + 1} AS MATERIALIZED (SELECT * FROM x{i} WHERE capture_id NOT IN (SELECT capture_id FROM m{i}))")
    out = []
    for i in range(5):
        chain, name = "", f"m{i}.kept"
        for j in range(i + 1, 5):
            chain += f" LEFT JOIN m{j} ON m{j}.capture_id = {name}"
            name = f"coalesce(m{j}.kept, {name})"
        out.append(f"SELECT m{i}.capture_id, {name} AS kept_id, {i} AS pass FROM m{i}{chain}")
    return f"WITH RECURSIVE {', '.join(parts)} {' UNION ALL '.join(out)}"


QUERIES = {
    "kept_attempts": kept_attempts, "evidence": evidence, "run_states": run_states, "latest_runs": latest_runs, "review_queue": review_queue, "uncached_queries": uncached_queries, "asset_states": asset_states,
    "matched_either": matched_either, "preferred_texts": preferred_texts, "revision_refs": revision_refs, "resumed_texts": resumed_texts, "asset_refresh": asset_refresh, "page_carriers": page_carriers,
    "citation_edges": citation_edges, "shared_announcements": shared_announcements, "case_groups": case_groups, "dedupe_five_passes": dedupe_five, "successors": successors, "contract_issues": contract_issues,
    "export_issues": export_issues, "normalized_issues": normalized_issues, "enumerations": enumerations, "subset_issues": subset_issues, "registry_issues": registry_issues, "cited_titles": cited_titles,
    "merged_related": merged_related, "compact_nodes": compact_nodes, "all_ids": all_ids, "ranked_documents": ranked_documents, "sample_prefix": sample_prefix, "sorted_refs": sorted_refs,
}
SQL = {
    "kept_attempts": f"WITH {_C} SELECT source_record_id, arg_max(capture_id, (coalesce(ok, false), fetched_at, capture_id)) AS capture_id, bool_or(coalesce(ok, false)) AS is_complete FROM c WHERE source_record_id IS NOT NULL GROUP BY 1",
    "evidence": f"WITH {_C} SELECT source_record_id, arg_min(endpoint_id, (fetched_at, endpoint_id)) AS owner, string_agg(DISTINCT endpoint_id, ',' ORDER BY endpoint_id) AS endpoints, string_agg(DISTINCT run_id, ',' ORDER BY run_id) AS runs FROM c WHERE source_record_id IS NOT NULL GROUP BY 1",
    "run_states": f"WITH {_C}, g AS (SELECT run_id, count(*) AS parts, count(*) FILTER (coalesce(ok, false) AND title IS NOT NULL) AS complete_parts, bool_and(CASE WHEN material_lane = 'rule' THEN ok END) AS p FROM c WHERE run_id IS NOT NULL GROUP BY 1) SELECT run_id, parts, complete_parts, parts = complete_parts AS is_complete, CASE WHEN p IS NULL THEN 'n/a' WHEN p AND parts = complete_parts THEN 'published' ELSE 'quarantined' END AS publish_status FROM g",
    "latest_runs": f"WITH {_C}, r AS (SELECT system, run_id, max(fetched_at) AS seen_at, bool_and(ok) AS whole FROM c WHERE system IS NOT NULL GROUP BY ALL) SELECT system, arg_max(run_id, (seen_at, run_id)) AS run_id, strftime(max(seen_at), '%Y-%m-%d %H:%M:%S.%f') AS seen_at FROM r WHERE whole GROUP BY 1",
    "review_queue": f"WITH {_C}, f AS (SELECT capture_id, fetched_at FROM c WHERE fileno IS NULL AND source_record_id NOT IN (SELECT source_record_id FROM c WHERE fileno IS NOT NULL) UNION ALL SELECT capture_id, fetched_at FROM c WHERE title IS NULL) SELECT capture_id, strftime(min(fetched_at), '%Y-%m-%d %H:%M:%S.%f') AS first_queued_at, strftime(max(fetched_at), '%Y-%m-%d %H:%M:%S.%f') AS last_queued_at FROM f WHERE capture_id NOT IN (SELECT capture_id FROM c WHERE page_role = 'supporting_material') GROUP BY 1",
    "uncached_queries": f"WITH q AS MATERIALIZED (SELECT doc_id, strftime(date_trunc('quarter', {_LD('pub_date')}), '%Y-%m-%d') AS quarter, lang, title FROM documents) SELECT quarter FROM q WHERE quarter IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (lang = 'zh') = 0 OR count(*) FILTER (lang = 'zh' AND title IS NULL) > 0",
    "asset_states": f"WITH u AS (SELECT unnest(assets) AS a FROM source_record), n AS MATERIALIZED (SELECT a.asset_id AS asset_id, min({_SHA('a.sha256')}) AS digest, min(a.local_file) AS file FROM u WHERE a.asset_id IS NOT NULL GROUP BY 1), {_LAST} SELECT n.asset_id, CASE WHEN l.st = 'failed' THEN NULL ELSE coalesce(l.digest, n.digest) END AS digest, CASE WHEN l.st = 'failed' THEN l.file ELSE coalesce(l.file, n.file) END AS file, CASE WHEN l.st = 'failed' THEN -1 WHEN l.asset_id IS NOT NULL THEN 0 ELSE 1 END AS state_of FROM n LEFT JOIN last l USING (asset_id)",
    "matched_either": f"WITH {_C}, a AS (SELECT DISTINCT capture_id, nullif({_NT('title')}, '') AS title, {_FN('fileno')} AS number FROM c), l AS MATERIALIZED (SELECT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawName') AS name, struct_extract(struct_extract(lawlist, 'law'), 'fileno') AS fileno FROM law_detail), b AS (SELECT DISTINCT law_id, nullif({_NT('name')}, '') AS title, {_FN('fileno')} AS number FROM l) SELECT DISTINCT a.capture_id, b.law_id, CASE WHEN a.title = b.title AND a.number = b.number THEN 'title,number' WHEN a.title = b.title THEN 'title' ELSE 'number' END AS by FROM a JOIN b ON a.title = b.title OR a.number = b.number",
    "preferred_texts": f"WITH l AS MATERIALIZED (SELECT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, struct_extract(struct_extract(lawlist, 'law'), 'bodyAftCntnt') AS a, struct_extract(struct_extract(lawlist, 'law'), 'bodyAgoCntnt') AS b FROM law_detail), d AS (SELECT law_id, min(full_text) AS t FROM law_document WHERE regexp_replace(full_text, '[{_WS}]+', '', 'g') <> '' GROUP BY 1), g AS (SELECT law_id, min(a) FILTER (regexp_replace(a, '[{_WS}]+', '', 'g') <> '') AS a, min(b) FILTER (regexp_replace(b, '[{_WS}]+', '', 'g') <> '') AS b FROM l WHERE law_id IS NOT NULL GROUP BY 1) SELECT law_id, sha256(coalesce(t, a, b)) AS text_hash, CASE WHEN t IS NOT NULL THEN 'document' WHEN a IS NOT NULL THEN 'after' WHEN b IS NOT NULL THEN 'ago' END AS origin FROM g LEFT JOIN d USING (law_id)",
    "revision_refs": f"WITH {_E}, g AS (SELECT from_id AS entity_id, min(to_id) FILTER (source = 'curated') AS a, min(to_id) FILTER (source = 'neris_revision') AS b, min(to_id) FILTER (source = 'catalog_inference') AS k FROM e WHERE relation = 'supersedes' GROUP BY 1) SELECT entity_id, coalesce(a, b, k) AS value, CASE WHEN a IS NOT NULL THEN 'curated' WHEN b IS NOT NULL THEN 'neris_revision' WHEN k IS NOT NULL THEN 'catalog_inference' END AS origin FROM g",
    "resumed_texts": f"SELECT DISTINCT local_file FROM asset_record WHERE download_status = 'downloaded' AND local_file IS NOT NULL AND local_file NOT IN (SELECT local_file FROM asset_text WHERE regexp_replace(plain_text, '[{_WS}]+', '', 'g') <> '')",
    "asset_refresh": f"WITH u AS (SELECT unnest(assets) AS a FROM source_record), s AS MATERIALIZED (SELECT a.asset_id AS asset_id, {_SHA('a.sha256')} AS sha FROM u), n AS (SELECT asset_id, min(sha) AS named, max(sha) AS other FROM s WHERE asset_id IS NOT NULL AND sha IS NOT NULL GROUP BY 1), {_LAST}, w AS (SELECT asset_id, CASE WHEN st IS NULL OR st IN ('pending', 'failed') THEN 'not_fetched' WHEN coalesce(size, 0) <= 0 THEN 'empty' WHEN named <> digest AND other <> digest THEN 'digest' END AS reason FROM last LEFT JOIN n USING (asset_id)) SELECT * FROM w WHERE reason IS NOT NULL",
    "page_carriers": f"WITH {_C} SELECT DISTINCT assets[1].asset_id AS asset_id, capture_id FROM c WHERE len(assets) = 1 AND day IS NOT NULL AND assets[1].asset_id IS NOT NULL AND NOT coalesce(regexp_matches(title, '送达公告|公告送达'), false) AND ({_SHA('assets[1].sha256')}) IS NOT NULL",
    "citation_edges": "WITH w AS MATERIALIZED (SELECT DISTINCT writ_id, b.law_id AS law_id FROM (SELECT writ_id, unnest(legal_basis) AS b FROM writ_document)) SELECT DISTINCT a.entity_id AS from_id, z.entity_id AS to_id FROM w JOIN source_map a ON a.source_system = 'writ' AND a.record_id = writ_id JOIN source_map z ON z.source_system = 'neris' AND z.record_id = law_id WHERE a.entity_id <> z.entity_id",
    "shared_announcements": f"WITH {_C}, s AS MATERIALIZED (SELECT DISTINCT capture_id, title, org, day FROM c WHERE org IS NOT NULL AND day IS NOT NULL AND title IS NOT NULL), t AS (SELECT org, day, count(DISTINCT title) AS titles, string_agg(DISTINCT '《' || title || '》', '、' ORDER BY '《' || title || '》') AS q FROM s GROUP BY ALL), g AS (SELECT org, day, titles, org || '现公布' || q AS body, len(regexp_extract_all(q, '《[^《》]{{4,120}}》')) AS quoted FROM t) SELECT capture_id, sha256(body) AS body_key, length(body) AS length FROM s JOIN g USING (org, day) WHERE titles >= 2 AND quoted >= 2",
    "case_groups": f"WITH RECURSIVE {_E}, b AS MATERIALIZED (SELECT from_id AS a, to_id AS b FROM e WHERE relation = 'same_instrument_copy' UNION SELECT to_id, from_id FROM e WHERE relation = 'same_instrument_copy'), n AS (SELECT from_id AS node FROM e WHERE relation IN ('same_instrument_copy', 'publishes') UNION SELECT to_id FROM e WHERE relation IN ('same_instrument_copy', 'publishes')), r AS (SELECT node, node AS reached FROM n UNION SELECT r.node, b.b FROM r JOIN b ON r.reached = b.a), g AS MATERIALIZED (SELECT node, min(reached) AS case_id FROM r GROUP BY 1) SELECT node, case_id, count(*) OVER (PARTITION BY case_id) AS size FROM g",
    "dedupe_five_passes": _five(),
    "successors": f"WITH {_C}, s AS MATERIALIZED (SELECT source_record_id AS id, min(title) AS title, min(org) AS org, min(day) AS day FROM c WHERE source_record_id IS NOT NULL GROUP BY 1), b AS MATERIALIZED (SELECT id, day, trim(regexp_replace(title, '[（(]\\s*(\\d{{4}}年(\\d{{1,2}}月)?)?修订\\s*[）)]$', '')) AS base FROM s WHERE regexp_matches(title, '[（(]\\s*(\\d{{4}}年(\\d{{1,2}}月)?)?修订\\s*[）)]$')), q AS MATERIALIZED (SELECT id, day, base, {_NT('base')} AS key FROM b WHERE length(base) BETWEEN 4 AND 120 AND NOT contains(base, '》')), w1 AS MATERIALIZED (SELECT id, day, title, unnest({_KEYS('title')}) AS k FROM s WHERE title IS NOT NULL), t AS (SELECT k, min(id) AS a, max(id) AS z, min(id) FILTER ({_NT('title')} = k) AS wa, max(id) FILTER ({_NT('title')} = k) AS wz FROM w1 GROUP BY 1), h AS (SELECT q.id AS from_id, q.day AS d0, q.base AS title, CASE WHEN a = z THEN a WHEN wa = wz THEN wa END AS to_id FROM q JOIN t ON t.k = q.key) SELECT from_id, to_id, 'explicit_repeal' AS inference, h.title FROM h JOIN s ON s.id = to_id WHERE from_id <> to_id AND (d0 IS NULL OR s.day IS NULL OR d0 >= s.day)",
    "contract_issues": "WITH r AS MATERIALIZED (SELECT DISTINCT * FROM source_record) SELECT 'required' AS check_id, count(*) AS n FROM r WHERE trim(coalesce(capture_id, '')) = '' OR trim(coalesce(source_record_id, '')) = '' OR trim(coalesce(source_system, '')) = '' OR trim(coalesce(ingest_status, '')) = '' UNION ALL SELECT 'enum_ingest_status', count(*) FROM r WHERE ingest_status NOT IN ('complete', 'incomplete', 'failed') UNION ALL SELECT 'enum_material_lane', count(*) FROM r WHERE material_lane NOT IN ('rule', 'reference', 'case', 'unknown') HAVING count(*) > 0",
    "export_issues": f"WITH {_E}, l AS MATERIALIZED (SELECT DISTINCT struct_extract(lawlist, 'law') AS x FROM law_detail), u AS (SELECT DISTINCT to_id FROM e WHERE to_id NOT IN (SELECT lower(entity_id) FROM source_map)), i AS (SELECT 'effective_before_published' AS check_id FROM l WHERE x.efctvDate < x.pubDate UNION ALL SELECT 'ended_before_effective' FROM l WHERE x.inefctvDate < x.efctvDate UNION ALL SELECT 'no_name' FROM l WHERE x.secFutrsLawName IS NULL OR regexp_replace(x.secFutrsLawName, '[{_WS}]+', '', 'g') = '' UNION ALL SELECT 'version_not_a_day' FROM l WHERE NOT regexp_matches(x.secFutrsLawVersion, '^[0-9]{{8}}$') UNION ALL SELECT 'edge_to_unknown' FROM u) SELECT check_id, count(*) AS n FROM i GROUP BY 1",
    "normalized_issues": f"WITH {_C}, f AS (SELECT local_file FROM asset_record WHERE download_status = 'downloaded' AND local_file IS NOT NULL), a AS (SELECT DISTINCT capture_id, x.local_file AS file FROM (SELECT capture_id, unnest(assets) AS x FROM c)), i AS (SELECT 'empty_text' AS check_id FROM c WHERE body IS NULL OR regexp_replace(body, '[{_WS}]+', '', 'g') = '' UNION ALL SELECT 'markup_left' FROM c WHERE regexp_matches(body, '</?(?:p|div|span|br|table|tr|td|a|img|script|style|ul|li)(?:\\s[^<>]*)?/?>') UNION ALL SELECT 'asset_missing' FROM a WHERE file IS NOT NULL AND file NOT IN (SELECT local_file FROM f)) SELECT check_id, count(*) AS n FROM i GROUP BY 1",
    "enumerations": "WITH m AS (SELECT l_orderkey, max(l_linenumber) AS reported FROM lineitem GROUP BY 1), g AS (SELECT l_orderkey, count(*) AS items, count(DISTINCT l_linenumber) AS pages, min(l_linenumber) AS a, max(l_linenumber) AS z, max(reported) AS reported FROM lineitem JOIN m USING (l_orderkey) WHERE l_suppkey % 7 <> 0 GROUP BY 1) SELECT 'page_gap' AS check_id, l_orderkey FROM g WHERE a <> 1 OR z <> pages UNION ALL SELECT 'total_differs', l_orderkey FROM g WHERE items <> reported",
    "subset_issues": f"WITH {_C}, k AS (SELECT DISTINCT run_id FROM c WHERE run_id IS NOT NULL AND system IS NOT NULL), p AS (SELECT run_id, lane FROM k CROSS JOIN (VALUES ('rule'), ('reference'), ('case')) v(lane)) SELECT run_id, lane FROM p ANTI JOIN (SELECT run_id, material_lane AS lane FROM c WHERE system IS NOT NULL) h USING (run_id, lane)",
    "registry_issues": f"WITH {_C}, a AS (SELECT DISTINCT endpoint_id AS key, system FROM c), b AS (SELECT DISTINCT {_CU('page_url', False)} AS key, endpoint_id FROM c) SELECT 'endpoint_of_systems' AS check_id, key, count(*) AS n FROM a WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1 UNION ALL SELECT 'address_of_endpoints', key, count(*) FROM b WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1",
    "cited_titles": f"WITH w AS MATERIALIZED (SELECT b.law_id AS law_id, b.entry_title AS t FROM (SELECT unnest(legal_basis) AS b FROM writ_document) WHERE b.law_id IS NOT NULL), d AS (SELECT law_id, min(struct_extract(metadata, 'name')) AS n FROM law_document WHERE regexp_replace(struct_extract(metadata, 'name'), '[{_WS}]+', '', 'g') <> '' GROUP BY 1), l AS (SELECT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id, min(struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawName')) AS n FROM law_detail WHERE regexp_replace(struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawName'), '[{_WS}]+', '', 'g') <> '' GROUP BY 1), g AS (SELECT law_id, min(t) FILTER (regexp_replace(t, '[{_WS}]+', '', 'g') <> '') AS t FROM w GROUP BY 1) SELECT law_id, coalesce(d.n, l.n, g.t) AS title, CASE WHEN d.n IS NOT NULL THEN 'document' WHEN l.n IS NOT NULL THEN 'detail' WHEN g.t IS NOT NULL THEN 'citation' END AS origin FROM g LEFT JOIN d USING (law_id) LEFT JOIN l USING (law_id)",
    "merged_related": f"WITH {_E}, w AS MATERIALIZED (SELECT DISTINCT writ_id, b.law_id AS law_id FROM (SELECT writ_id, unnest(legal_basis) AS b FROM writ_document)), k AS (SELECT DISTINCT lower(a.entity_id) AS from_id, lower(z.entity_id) AS to_id FROM w JOIN source_map a ON a.source_system = 'writ' AND a.record_id = writ_id JOIN source_map z ON z.source_system = 'neris' AND z.record_id = law_id WHERE a.entity_id <> z.entity_id), u AS (SELECT DISTINCT from_id, to_id, 0 AS origin FROM e WHERE relation = 'related_to' UNION ALL SELECT from_id, to_id, 1 FROM k) SELECT from_id, to_id, min(origin) AS origin FROM u GROUP BY ALL",
    "compact_nodes": f"WITH {_E}, n AS (SELECT from_id AS node_id FROM e UNION SELECT to_id FROM e), x AS (SELECT 'neris' AS s, law_id AS r, struct_extract(metadata, 'name') AS name FROM law_document UNION ALL SELECT 'writ', writ_id, struct_extract(metadata, 'name') FROM writ_document), m AS (SELECT lower(entity_id) AS node_id, bool_or(source_system = 'writ') AS w, bool_or(source_system = 'neris') AS l, min(name) AS name FROM source_map LEFT JOIN x ON s = source_system AND r = record_id GROUP BY 1) SELECT node_id, CASE WHEN w THEN 'writ' WHEN l THEN 'law' WHEN w IS NULL THEN 'stub' ELSE 'other' END AS kind, name IS NULL AS nameless FROM n LEFT JOIN m USING (node_id)",
    "all_ids": "SELECT law_id FROM (SELECT struct_extract(struct_extract(lawlist, 'law'), 'secFutrsLawId') AS law_id FROM law_detail UNION SELECT law_id FROM law_document UNION SELECT b.law_id FROM (SELECT unnest(legal_basis) AS b FROM writ_document)) WHERE law_id IS NOT NULL",
    "ranked_documents": f"WITH x AS (SELECT doc_id, {_LD('pub_date')} AS day FROM documents) SELECT doc_id, day, row_number() OVER (ORDER BY day DESC NULLS LAST, doc_id) AS place FROM x",
    "sample_prefix": "SELECT doc_id, sha256(CAST(doc_id AS VARCHAR)) AS h FROM documents ORDER BY h LIMIT 50",
    "sorted_refs": f"WITH {_E}, d AS MATERIALIZED (SELECT DISTINCT from_id, to_id, relation FROM e WHERE relation IN ('supersedes', 'finalizes_draft', 'publishes')), r AS (SELECT from_id AS node, relation, to_id AS other, 'out' AS way FROM d UNION ALL SELECT to_id, relation, from_id, 'in' FROM d) SELECT node, string_agg(relation || ':' || other || ':' || way, ' ' ORDER BY relation, other, way) AS refs FROM r GROUP BY 1",
}
