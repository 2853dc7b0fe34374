"""Problem 4: the best representative of each group of captures, in consistent bundles.

Fields that depend on one another form a bundle, and a bundle survives whole, from one
capture. The selection that survives is the most trusted one that keeps the functional
dependencies between bundles, found by branch and bound, level by level and for all
entities at once:

* candidates: of the captures of a bundle with one value the best stands for all;
* bound: the best candidate of every bundle together is what no selection can beat; where
  it keeps the dependencies, it is the optimum and the entity is done, as every entity is
  if nothing ties its bundles;
* branch: entities whose bound isn't reached branch over the values of the determining
  bundle, each with the dependent values seen with it, or without one of the two. A branch
  whose trust with the best dependent value stays below what is already reached is cut
  off before it is joined.

The levels are aggregations and joins with partial results, so an entity of any size is
never in one task.

Trust: ingest_status complete first, then the lower trust_rank, then the later fetched_at;
ties go to the smaller capture_id. A null rank or time comes last.

Results in special cases: entities with one capture, fields without a usable value and
empty tables give no row; repeated rows count once; a null or unmapped system or record id
belongs to no entity; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.functions.dates import lenient_date
from canonry.functions.text import canonical_system, compact, digest, narrow
from canonry.session import table

#: What error pages and place-holders say instead of a text.
PLACE_HOLDER = (
    r"(?i)^(?:.{0,20}(?:正在跳转|页面不存在|不存在或已删除|页面加载中|系统维护中|访问被拒绝|无法访问|请稍候|请稍后(?:访问|再试)|enable javascript|access denied|request blocked"
    r"|404|not found|forbidden|bad gateway|service unavailable|internal server error|under maintenance|loading|redirecting).{0,40})$"
)
#: An error page has no more characters than this.
PLACE_HOLDER_LENGTH = 60
#: A real number of an instrument has a year and a serial number; full-width digits count.
FILENO = r"(?:19|20)\d{2}\D{0,4}\d+"


def is_text(text: Column) -> Column:
    """Not blank, and no error page or place-holder."""
    bare = F.regexp_replace(text, r"^[\s\x{3000}\x{A0}]+|[\s\x{3000}\x{A0}]+$", "")
    short = F.length(bare) <= PLACE_HOLDER_LENGTH
    return F.coalesce((F.length(compact(text)) > 0) & ~(short & F.regexp_replace(bare, r"[\r\n]+", " ").rlike(PLACE_HOLDER)), F.lit(False))


def captures(records: DataFrame, source_map: DataFrame, trust: DataFrame) -> DataFrame:
    """Captures with their entity, whether each field is usable, and ``order`` (least first)."""
    digests = F.exists("assets", lambda a: digest(a["sha256"]).isNotNull())
    own = records.select(
        canonical_system(F.col("source_system")).alias("system"),
        F.col("source_record_id").alias("record_id"),
        "capture_id",
        is_text(F.col("content.plain_text")).alias("content"),
        F.coalesce(digests, F.lit(False)).alias("assets"),
        F.coalesce(narrow(F.col("metadata.fileno")).rlike(FILENO), F.lit(False)).alias("fileno"),
        lenient_date(F.col("metadata.pub_date")).isNotNull().alias("pub_date"),
        (F.lower(compact(F.col("ingest_status"))) != F.lit("complete")).alias("incomplete"),
        F.col("fetched_at").cast("timestamp").alias("at"),
        F.upper(compact(narrow(F.col("metadata.fileno")))).alias("fileno_value"),
        lenient_date(F.col("metadata.pub_date")).alias("date_value"),
    ).where(F.col("capture_id").isNotNull())
    known = source_map.select(canonical_system(F.col("source_system")).alias("system"), "record_id", "entity_id").distinct()
    ranks = trust.select(canonical_system(F.col("source_system")).alias("system"), F.col("trust_rank").alias("rank"))
    order = F.struct(
        F.coalesce("incomplete", F.lit(True)).alias("incomplete"),
        F.coalesce("rank", F.lit(1 << 30)).alias("rank"),
        F.coalesce(-F.unix_micros("at"), F.lit(1 << 62)).alias("age"),
        F.col("capture_id"),
    )
    return own.join(known, ["system", "record_id"]).join(ranks, "system", "left").withColumn("order", order)


FIELDS = ("content", "assets", "fileno", "pub_date")
#: Of each field that can take part in a dependency, the column of ``captures`` with its value.
VALUE = {"fileno": "fileno_value", "pub_date": "date_value"}


def _trust(order: Column) -> Column:
    """Trust that adds up over bundles: completeness, then the rank."""
    return F.when(order["incomplete"], 1.0).otherwise(2.0) - F.least(order["rank"], F.lit(1000)) / 2000.0


def _bounds(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The best candidate (order, value) of every bundle of each entity with several captures."""
    value = lambda f: F.col(VALUE[f]).cast("string") if f in VALUE else F.lit(None).cast("string")
    best = (F.min(F.when(F.col(f), F.struct("order", value(f).alias("value")))).alias(f) for f in fields)
    return rows.groupBy("entity_id").agg(F.min("capture_id").alias("first"), F.max("capture_id").alias("last"), *best).where("first <> last").drop("first", "last")


def _branched(rows: DataFrame, bounds: DataFrame, a: str, b: str) -> DataFrame:
    """entity_id, a, b (candidates or null) of the most trusted selection of the entities in
    which the value of bundle ``a`` determines that of ``b`` and the bound breaks this."""
    own = rows.select("entity_id", "order", F.when(F.col(a), F.col(VALUE[a]).cast("string")).alias("va"), F.when(F.col(b), F.col(VALUE[b]).cast("string")).alias("vb"))
    # Values seen together, once each; what is seen with the best value of a tells whether the bound is reached.
    seen = own.where("va is not null and vb is not null").select("entity_id", "va", "vb").distinct()
    both = bounds.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select("entity_id", F.col(a).alias("a"), F.col(b).alias("b"))
    at_best = both.join(seen, "entity_id").where("a.value = va")
    broken = at_best.groupBy("entity_id").agg(F.first("a").alias("a"), F.first("b").alias("b"), F.max(F.expr("b.value = vb")).alias("reached")).where("not reached").drop("reached")
    mine = own.join(broken.select("entity_id"), "entity_id", "left_semi")
    of = lambda v, s: mine.where(f"{v} is not null").groupBy("entity_id", v).agg(F.min("order").alias(s)).select("entity_id", v, F.struct(F.col(s).alias("order"), F.col(v).alias("value")).alias(s))
    ca, cb = of("va", "ca"), of("vb", "cb")
    paired = seen.join(broken.select("entity_id"), "entity_id", "left_semi")
    # Reached without a join of both: one bundle alone, or a value of a that no value of b is seen with.
    free = ca.join(paired, ["entity_id", "va"], "left_anti").groupBy("entity_id").agg(F.min("ca").alias("free"))
    start = broken.join(free, "entity_id", "left")
    none = F.lit(None).cast(cb.schema["cb"].dataType)
    alone = start.select("entity_id", F.explode(F.array(F.struct(F.col("a").alias("ca"), none.alias("cb")), F.struct(none.alias("ca"), F.col("b").alias("cb")), F.struct(F.col("free").alias("ca"), F.col("b").alias("cb")))).alias("x")).select("entity_id", "x.*")
    trust = lambda c: F.coalesce(_trust(F.col(c)["order"]), F.lit(0.0))
    reached = start.select("entity_id", F.col("b").alias("best_b"), F.greatest(trust("a"), trust("b"), F.when(F.col("free").isNotNull(), trust("free") + trust("b"))).alias("reached"))
    open_a = ca.join(reached, "entity_id").where(trust("ca") + trust("best_b") >= F.col("reached")).select("entity_id", "va", "ca")
    joined = paired.join(open_a, ["entity_id", "va"]).join(cb, ["entity_id", "vb"]).select("entity_id", "ca", "cb")
    key = F.struct(-(trust("ca") + trust("cb")), F.col("ca").isNull(), F.col("ca"), F.col("cb"))
    return joined.unionByName(alone).groupBy("entity_id").agg(F.min_by(F.struct("ca", "cb"), key).alias("x")).select("entity_id", F.col("x.ca").alias(a), F.col("x.cb").alias(b))


def survivors(rows: DataFrame, dependencies: Sequence[tuple[str, str]] = (), fields: Sequence[str] = FIELDS) -> DataFrame:
    """(entity_id, field_name, capture_id) of the selection that survives of each entity.

    ``dependencies`` are pairs (a, b): where a value of a is seen with values of b in any
    capture of the entity, the two that survive must be seen together. No field may be in
    two dependencies.
    """
    chosen = _bounds(rows, fields)
    for a, b in dependencies:
        other = _branched(rows, chosen, a, b).select("entity_id", F.struct(F.col(a).alias("a"), F.col(b).alias("b")).alias("other"))
        chosen = chosen.join(other, "entity_id", "left").withColumns({f: F.when(F.col("other").isNotNull(), F.col(f"other.{s}")).otherwise(F.col(f)) for f, s in ((a, "a"), (b, "b"))}).drop("other")
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f)["order"]["capture_id"].alias("capture_id")) for f in fields)))
    return chosen.select("entity_id", each.alias("x")).select("entity_id", "x.*").where("capture_id is not null")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures(*(table(spark, sf_dir, t) for t in ("source_record", "source_map", "source_trust")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving capture of each entity and field; each field is a bundle, and none depends on another."""
    return survivors(_rows(spark, sf_dir))


def p4_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with number and date tied together: they must have been seen together."""
    return survivors(_rows(spark, sf_dir), [("fileno", "pub_date")])


_SYS = "replace(lower(trim({0}, ' ' || chr(9) || chr(10))), '-', '_')"
P4_SQL = rf"""
WITH r AS (
  SELECT DISTINCT capture_id, source_record_id, {_SYS.format("source_system")} AS system, lower(trim(ingest_status)) AS st, fetched_at,
    struct_extract(content, 'plain_text') AS t, struct_extract(metadata, 'fileno') AS f, struct_extract(metadata, 'pub_date') AS d,
    list_transform(assets, lambda a: a.sha256) AS shas
  FROM source_record
), b AS (
  SELECT *, trim(regexp_replace(t, '^[ \t\n\r\x{{3000}}\x{{A0}}]+|[ \t\n\r\x{{3000}}\x{{A0}}]+$', '', 'g')) AS bare,
    regexp_replace(d, '^(\d{{4}})[-/.年]?(\d{{1,2}})[-/.月]?(\d{{1,2}})日?( .*)?$', '\1-\2-\3') AS iso
  FROM r
), u AS (
  SELECT m.entity_id, b.capture_id, b.st, b.fetched_at, coalesce(k.trust_rank, 1 << 30) AS rank,
    bare <> '' AND NOT (length(bare) <= 60 AND regexp_matches(bare, '跳转|不存在|加载中|维护中|JavaScript|denied|404')) AS content,
    len(list_filter(shas, lambda s: regexp_matches(lower(trim(s)), '^(sha256:)?[0-9a-f]{{64}}$'))) > 0 AS assets,
    regexp_matches(translate(f, '０１２３４５６７８９', '0123456789'), '(19|20)\d\d.*\d') AS fileno,
    (regexp_matches(d, '^\d{{8}}$') OR regexp_matches(d, '^\d{{4}}[-/.年]\d{{1,2}}[-/.月]\d{{1,2}}')) AND try_cast(iso AS DATE) IS NOT NULL AS pub_date
  FROM b JOIN (SELECT DISTINCT * FROM source_map) m ON m.source_system = b.system AND m.record_id = b.source_record_id LEFT JOIN source_trust k ON k.source_system = b.system
), e AS (SELECT entity_id FROM u GROUP BY 1 HAVING count(DISTINCT capture_id) > 1),
x AS (
  SELECT entity_id, capture_id, st, fetched_at, rank, unnest(['content', 'assets', 'fileno', 'pub_date']) AS field_name, unnest([content, assets, fileno, pub_date]) AS ok FROM u SEMI JOIN e USING (entity_id)
), n AS (
  SELECT *, row_number() OVER (PARTITION BY entity_id, field_name ORDER BY coalesce(st, '') <> 'complete', rank, fetched_at DESC NULLS LAST, capture_id) AS k FROM x WHERE ok
)
SELECT entity_id, field_name, capture_id FROM n WHERE k = 1
"""

QUERIES = {"p4_found": p4_found, "p4_bundles": p4_bundles}
SQL = {"p4_found": P4_SQL}
