"""Problem 5: consolidating pairwise matches into groups, by low-diameter decomposition.

Every vertex draws an exponentially distributed head start from a hash of its id. Clusters
grow from these shifted starts: a vertex joins the centre that maximises head start minus
distance. Clusters contract to super-vertices, the edges between clusters form the next,
smaller graph, and so on until no edge is left. The assignments of all levels compose to
one group per entity. Entities are numbered in their order, so that all levels work on
numbers, the least number of a group is its smallest entity, and what a vertex is offered,
head start and centre, is one number whose maximum is aggregated by hash.

Results in special cases: an empty table, or one without usable links, gives no row; links
with a null or blank end, self-links and links of other relations count for nothing;
repeated and reversed links count once; extra columns are ignored. A chain or star of any
size is one group; ties between centres go to the larger id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.functions.text import SPACE
from canonry.session import cut, release, table

#: Rate of the exponential head starts; their mean, 1 / RATE, is the usual cluster radius.
RATE = 0.3
#: Hops that clusters grow before they contract. Growth cut short only means one more level.
HOPS = 3
#: Links of one vertex that share a salt; a vertex with more is spread over several tasks.
LINKS_PER_SALT = 20_000
#: An offer is score * 2 ** CENTRE_BITS + centre; scores have SCORE_BITS binary places.
CENTRE_BITS, SCORE_BITS = 40, 15


def _trim_lower(x: Column) -> Column:
    return F.nullif(F.lower(F.regexp_replace(x, f"^[{SPACE}]+|[{SPACE}]+$", "")), F.lit(""))


def links(relations: DataFrame, relation: str = "same_instrument_copy") -> DataFrame:
    """Distinct undirected links (u < v) of one relation, with cleaned ids."""
    a, b = _trim_lower(F.col("from_id")), _trim_lower(F.col("to_id"))
    return (
        relations.where(_trim_lower(F.col("relation")) == relation)
        .select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), a.isNotNull().alias("ok_a"), b.isNotNull().alias("ok_b"))
        .where("ok_a and ok_b and u <> v")
        .select("u", "v")
        .distinct()
    )


def numbered(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity, number) of every entity, numbers ascending with the entities from 0, and the edges in numbers."""
    ids = edges.select(F.col("u").alias("entity")).unionAll(edges.select(F.col("v").alias("entity"))).distinct().sort("entity")
    ids = cut(ids.select("entity", F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", 33)
    sizes = sorted((r.part, r.n) for r in ids.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row per task of the sort
    total, first = 0, []
    for p, n in sizes:
        first.append((p, total))
        total += n
    if total >> CENTRE_BITS:
        raise ValueError(f"more than 2 ** {CENTRE_BITS} entities")
    offsets = F.broadcast(edges.sparkSession.createDataFrame(first, "part bigint, first bigint"))
    numbers = cut(ids.withColumn("part", part).join(offsets, "part").select("entity", (F.col("first") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("number")))
    release(ids)
    at = lambda c: numbers.select(F.col("entity").alias(c), F.col("number").alias(f"n{c}"))
    return numbers, cut(edges.join(at("u"), "u").join(at("v"), "v").select(F.col("nu").alias("u"), F.col("nv").alias("v")))


def _first_offer(v: Column, level: int) -> Column:
    """A vertex's own offer: its head start, to be its own centre."""
    uniform = (F.pmod(F.xxhash64(v, F.lit(level)), F.lit(1 << 40)) + F.lit(1)) / F.lit(float((1 << 40) + 1))
    score = F.floor(-F.log(uniform) / F.lit(RATE) * F.lit(float(1 << SCORE_BITS)))
    return score.cast("bigint") * F.lit(1 << CENTRE_BITS) + v


def _grow(edges: DataFrame, level: int) -> DataFrame:
    """One decomposition of the graph: (vertex, centre), a centre for each vertex with an edge."""
    both = edges.select(F.col("u").alias("src"), F.col("v").alias("dst")).unionAll(edges.select(F.col("v").alias("src"), F.col("u").alias("dst")))
    degree = both.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / LINKS_PER_SALT).cast("int").alias("salts"))
    vertices = cut(degree.select(F.col("src").alias("vertex"), "salts"))
    far = F.lit(1 << (CENTRE_BITS + SCORE_BITS))
    arcs = both.join(vertices.select(F.col("vertex").alias("src"), "salts"), "src").select(
        "src", F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int").alias("salt"), "dst", far.alias("cost"), F.lit(None).cast("int").alias("salts")
    )
    # A vertex offers itself what it has, so that a hop reads the state once.
    own = vertices.select(F.col("vertex").alias("src"), F.lit(0).alias("salt"), F.col("vertex").alias("dst"), F.lit(0).cast("bigint").alias("cost"), "salts")
    arcs = cut(arcs.unionAll(own))
    state = vertices.select("vertex", "salts", _first_offer(F.col("vertex"), level).alias("best"))
    for _ in range(HOPS):
        spread = state.select(F.col("vertex").alias("src"), "best", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        offers = arcs.join(spread, ["src", "salt"]).select(F.col("dst").alias("vertex"), "salts", (F.col("best") - F.col("cost")).alias("best"))
        state = offers.groupBy("vertex").agg(F.max("salts").alias("salts"), F.max("best").alias("best"))
    grown = cut(state.select("vertex", F.pmod("best", F.lit(1 << CENTRE_BITS)).alias("centre")))
    release(vertices, arcs)
    return grown


def components(edges: DataFrame) -> DataFrame:
    """(entity, group): the smallest entity that each one is linked with, directly or not.

    ``edges`` holds distinct links (u, v) with u < v, both strings.
    """
    named = cut(edges)
    if named.isEmpty():
        return named.select(F.col("u").alias("entity"), F.col("v").alias("group"))
    numbers, edges = numbered(named)
    release(named)
    level, assigned, least = 0, [], None  # assigned: of each level, its clusters and what is smallest below them
    while not edges.isEmpty():
        clusters = _grow(edges, level)
        # The smallest entity below each super-vertex, carried upwards.
        own = clusters.withColumn("low", F.col("vertex")) if least is None else clusters.join(least, clusters["vertex"] == least["super"]).select("vertex", "centre", "low")
        least = cut(own.groupBy(F.col("centre").alias("super")).agg(F.min("low").alias("low")))
        at = lambda c: clusters.select(F.col("vertex").alias(c), F.col("centre").alias(f"c{c}"))
        before = edges
        edges = cut(
            edges.join(at("u"), "u").join(at("v"), "v").where("cu <> cv").select(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).distinct()
        )
        release(before)
        assigned.append((clusters, least))
        level += 1
    release(edges)
    # Downwards again: a super-vertex without edges keeps its own low, the others take that of the level above.
    found = None
    for clusters, low in reversed(assigned):
        if found is None:
            of_super = low.select("super", F.col("low").alias("group"))
        else:
            of_super = low.join(found.select(F.col("entity").alias("super"), "group"), "super", "left").select("super", F.coalesce("group", "low").alias("group"))
        above, found = found, cut(clusters.join(of_super, clusters["centre"] == of_super["super"]).select(F.col("vertex").alias("entity"), "group"))
        release(clusters, low, *([above] if above is not None else []))
    name = lambda c: numbers.select(F.col("number").alias(c), F.col("entity").alias(f"{c}_name"))
    out = cut(found.join(name("entity"), "entity").join(name("group"), "group").select(F.col("entity_name").alias("entity"), F.col("group_name").alias("group")))
    release(found, numbers)
    return out


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per linked entity: entity_id and group_id, the smallest id of its group."""
    found = components(links(table(spark, sf_dir, "catalog_relation")))
    return found.select(F.col("entity").alias("entity_id"), F.col("group").alias("group_id"))


P5_SQL = """
WITH RECURSIVE e AS (
  SELECT DISTINCT lower(trim(from_id, ' ' || chr(9) || chr(10) || chr(13))) AS a, lower(trim(to_id, ' ' || chr(9) || chr(10) || chr(13))) AS b
  FROM catalog_relation
  WHERE lower(trim(relation, ' ' || chr(9) || chr(10) || chr(13))) = 'same_instrument_copy' AND from_id IS NOT NULL AND to_id IS NOT NULL
), s AS (
  SELECT a, b FROM e WHERE a <> b AND a <> '' AND b <> '' UNION SELECT b, a FROM e WHERE a <> b AND a <> '' AND b <> ''
), r AS (
  SELECT a AS entity_id, a AS reached FROM s
  UNION
  SELECT r.entity_id, s.b FROM r JOIN s ON r.reached = s.a
)
SELECT entity_id, min(reached) AS group_id FROM r GROUP BY entity_id
"""

QUERIES = {"p5_found": p5_found}
SQL = {"p5_found": P5_SQL}
