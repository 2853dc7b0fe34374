"""Problem 2: near-duplicate records, by a MinHash LSH forest with exact verification.

Records with the same text (lower-cased, without white space) form one class, and only one
of each class goes on. Its 5-character sequences are hashed once; the least hash of each
of BINS ranges is its signature (one permutation, empty ranges filled from others). Every
tree of the forest gives a record a label, a byte of each of DEPTHS[0] signature values of
its own; labels of a tree, sorted, are its prefix trie, and two records meet in the tree
under the longest prefix that they share. How far matched prefixes must be shortened is
told by a few pilot trees: of the pairs that meet there under a long prefix, and whose bit
sketches are near enough, the similarity s is estimated, and with it the chance that a pair
of this kind meets, 1 - (1 - s^depth)^trees. Each weighed by its inverse, the pairs tell how
all pairs are spread, and so the recall of the forest at every depth. The depth taken is
the longest whose recall, less two standard errors, reaches the target; the last one does
for every pair of the threshold's similarity. So the many pairs that share little never
meet, unless the records that do share enough demand it. Pairs are then verified exactly on
the texts. Only labels and sketches are shuffled for all records; texts move for verified
pairs alone.

Results in special cases: null and blank texts and texts of fewer than five characters
match nothing; repeated rows count once; an id with several texts matches by any of them;
empty tables give no rows; extra columns are ignored; texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.functions.text import digest
from canonry.session import cut, release, table

WIDTH = 5
THRESHOLD = 0.6
RECALL = 0.995
#: Values of a signature, trees, and the depths of matched prefixes by turns, a value of its own for each tree and depth.
BINS, TREES, DEPTHS = 1024, 66, (12, 11, 10, 9, 8, 7, 6, 5)
#: Pilot trees and the depth of their prefixes.
PILOT_TREES, PILOT_DEPTH = 8, 10
#: Pairs found that it takes to estimate recall from; with fewer the last depth decides.
LEAST_PAIRS = 100
#: Bits of the sketch that may differ: four standard deviations beyond what the threshold gives.
SKETCH = 256
#: Bytes, measured, up to which a table of classes or ids is broadcast; a larger one is joined by a shuffle.
BROADCAST_BYTES = 16 << 20
_EXPECTED = SKETCH * (1 - THRESHOLD) / 2
MOST_DIFFERENT = int(_EXPECTED + 4 * (SKETCH * (1 - THRESHOLD) / 2 * (1 + THRESHOLD) / 2) ** 0.5)


def chance(similarity: float | Column, depth: int, trees: int = TREES) -> float | Column:
    """Chance that two records of this similarity share a prefix of this depth in some tree; a byte of two different values is equal by chance, too."""
    equal = similarity + (1 - similarity) / 256
    return 1 - (1 - equal**depth) ** trees


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(text: str) -> np.ndarray:
    """Sorted distinct hashes of a text's character sequences."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(code) < WIDTH:
        return np.empty(0, np.uint64)
    h = np.zeros(len(code) - WIDTH + 1, np.uint64)
    for i in range(WIDTH):
        h = h * np.uint64(0x9E3779B97F4A7C15) + code[i : i + len(h)]
    return np.unique(_mix(h))


#: Where an empty range looks for a value, by turns.
_PROBES = np.stack([_mix(np.arange(BINS, dtype=np.uint64) * np.uint64(1_000_003) + np.uint64(t)) % np.uint64(BINS) for t in range(64)]).astype(np.int64)


def signature(h: np.ndarray) -> np.ndarray:
    """The least hash of each range of hash values; empty ranges take that of another one."""
    shift = np.uint64(64 - (BINS - 1).bit_length())
    bins = (h >> shift).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    out, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    out[bins[first]], filled[bins[first]] = h[first] << np.uint64(64 - int(shift)), True
    empty = np.flatnonzero(~filled)
    full = filled.copy()
    for turn in range(len(_PROBES)):
        if not len(empty):
            break
        to = _PROBES[turn][empty]
        ok = full[to]
        out[empty[ok]] = _mix(out[to[ok]] + np.uint64(turn + 1))
        empty = empty[~ok]
    if len(empty):  # only where there are few values: each range takes the least under its own hash
        out[empty] = _mix(h[:, None] + (empty.astype(np.uint64) << np.uint64(40))[None, :]).min(axis=0)
    return out


def _normal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts in lower case without white space, blank ones left out, with the key of the class of equal ones."""
    for batch in batches:
        out = batch[["kind", "id"]].copy()
        out["text"] = ["".join(t.lower().split()) for t in batch.text]
        out["key"] = [xxhash.xxh3_128_hexdigest(f"{k}\n{t}".encode("utf-8", "replace")) for k, t in zip(out.kind, out.text, strict=True)]
        yield out[out.text != ""]


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in _normal(batches):
        rows = []
        for text in batch.text:
            h = grams(text)
            if not len(h):
                rows.append((0, None, 0, 0, 0, 0))
                continue
            sig = signature(h)
            label = ((sig[: TREES * DEPTHS[0]] >> np.uint64(33)) & np.uint64(0xFF)).astype(np.uint8)
            bits = np.packbits(((sig[:: BINS // SKETCH] >> np.uint64(17)) & np.uint64(1)).astype(np.uint8)).view(np.int64)
            rows.append((len(h), label.tobytes(), *bits.tolist()))
        own = pd.DataFrame(rows, columns=["n", "label", "s0", "s1", "s2", "s3"])
        yield pd.concat([batch[["kind", "id", "key"]].reset_index(drop=True), own], axis=1)


def _verify(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = []
        last, own = None, None
        for a, b in zip(batch.text_a, batch.text_b, strict=True):
            if a != last:
                last, own = a, grams(a)
            other = grams(b)
            common = len(np.intersect1d(own, other, assume_unique=True))
            keep.append(common >= threshold * (len(own) + len(other) - common) - 1e-9)
        yield batch.loc[keep, ["kind", "a", "b"]]


def classes(rows: DataFrame) -> DataFrame:
    """kind, id, text, key of ``rows`` (kind, id, text): key names the class of equal texts."""
    return rows.where("id is not null and text is not null").select("kind", "id", "text").mapInPandas(_normal, "kind string, id string, text string, key string")


def sketches(rows: DataFrame) -> DataFrame:
    """kind, id, key of every record with a text, its number of sequences, label of all trees and sketch."""
    own = rows.where("id is not null and text is not null").select("kind", "id", "text")
    return cut(own.mapInPandas(_sketch, "kind string, id string, key string, n int, label binary, s0 bigint, s1 bigint, s2 bigint, s3 bigint"))


def _few(df: DataFrame) -> DataFrame:
    """Marked for broadcast where its bytes, measured, are few enough; else as it is."""
    size = [F.coalesce(F.length(f.name), F.lit(0)) + 16 if f.dataType.typeName() in ("string", "binary") else F.lit(8) for f in df.schema]
    held = df.agg(F.sum(sum(size[1:], size[0]))).first()[0] or 0
    return F.broadcast(df) if held <= BROADCAST_BYTES else df


def meetings(one: DataFrame, depth: int, threshold: float, trees: int = TREES) -> DataFrame:
    """(a, b, differing), a < b: classes that share a prefix of this depth in some tree and
    whose sketches are near enough, with the number of bits that differ.

    A prefix that very many share is split over tasks by AQE; beyond copies of one text,
    which are one class, many share a long prefix only if they are near-duplicates, whose
    pairs are the result.
    """
    tree = one.select("class", "kind", "n", "label", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    prefix = F.xxhash64("kind", "tree", F.expr(f"substring(label, tree * {DEPTHS[0]} + 1, {depth})"))
    leaves = tree.select(prefix.alias("prefix"), "class", "n")
    x, y = (leaves.select("prefix", F.col("class").alias(s), F.col("n").alias(f"n_{s}")) for s in "ab")
    met = x.join(y, "prefix").where((F.col("a") < F.col("b")) & (F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))).select("a", "b").distinct()
    bits = _few(one.select("class", "kind", "s0", "s1", "s2", "s3"))
    of = lambda s: bits.select(F.col("class").alias(s), F.col("kind").alias(f"kind_{s}"), *(F.col(f"s{i}").alias(f"{s}{i}") for i in range(4)))
    differing = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(1, 4)), F.bit_count(F.col("a0").bitwiseXOR(F.col("b0"))))
    near = met.join(of("a"), "a").join(of("b"), "b").where((F.col("kind_a") == F.col("kind_b")) & (differing <= MOST_DIFFERENT))
    return cut(near.select("a", "b", differing.alias("differing")))


def depth_for(pilot: DataFrame, threshold: float, recall: float) -> int:
    """The longest prefix with which the forest reaches the recall, by the pairs met in the pilot trees."""
    similarity = F.lit(1.0) - F.col("differing") * 2.0 / SKETCH
    own = pilot.where(similarity >= threshold).select(similarity.alias("s")).select("s", (1 / chance(F.col("s"), PILOT_DEPTH, PILOT_TREES)).alias("w"))
    missed = {d: 1 - chance(F.col("s"), d) for d in DEPTHS}
    each = [x for d in DEPTHS for x in (F.sum(F.col("w") * missed[d]).alias(f"m{d}"), F.sum(F.col("w") * (F.col("w") - 1) * missed[d] ** 2).alias(f"v{d}"))]
    r = own.agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("all"), *each).first()
    for d in DEPTHS:
        if r.n >= LEAST_PAIRS and r[f"m{d}"] + 2 * r[f"v{d}"] ** 0.5 <= (1 - recall) * r["all"]:
            return d
    return next(d for d in DEPTHS if d == DEPTHS[-1] or chance(threshold, d) >= recall)


def candidates(one: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Pairs of classes that meet in the forest, under prefixes as long as the target recall allows."""
    pilot = meetings(one, PILOT_DEPTH, threshold, PILOT_TREES)
    found = meetings(one, depth_for(pilot, threshold, recall), threshold)
    release(pilot)
    return found


def near_pairs(rows: DataFrame, known: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(kind, a, b), a < b: the classes of ``rows`` that are similar enough; ``known`` has their sketches."""
    first = known.where("n > 0").groupBy("kind", "key").agg(F.min("id").alias("id"))
    own = known.join(first, ["kind", "key", "id"]).dropDuplicates(["kind", "key"])
    one = cut(own.withColumn("class", F.xxhash64("kind", "key")))
    met = candidates(one, threshold, recall)
    # Texts of candidates, one record for each class.
    wanted = met.select(F.col("a").alias("class")).unionAll(met.select(F.col("b").alias("class"))).distinct()
    ids = cut(one.select("class", "kind", "key", "id").join(wanted, "class", "left_semi"))
    few = _few(ids.select("kind", "id", "key", "class"))
    held = cut(classes(rows.join(_few(ids.select("kind", "id").distinct()), ["kind", "id"], "left_semi")).join(few, ["kind", "id", "key"]).dropDuplicates(["kind", "key"]))
    left, right = (held.select("kind", F.col("class").alias(s), F.col("key").alias(f"key_{s}"), F.col("text").alias(f"text_{s}")) for s in "ab")
    pairs = met.join(left, "a").join(right, ["kind", "b"])
    named = pairs.select("kind", F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"), "text_a", "text_b")
    found = cut(named.mapInPandas(lambda it: _verify(it, threshold), "kind string, a string, b string"))
    release(one, met, ids, held)
    return found


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    law = table(spark, sf_dir, "law_document").select(F.lit("law").alias("kind"), F.col("law_id").alias("id"), F.col("full_text").alias("text"))
    writ = table(spark, sf_dir, "writ_document").select(F.lit("writ").alias("kind"), F.col("writ_id").alias("id"), F.col("body").alias("text"))
    return law.unionAll(writ)


def _assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "asset_record").where("size_bytes > 0").select("asset_id", digest(F.col("sha256")).alias("sha")).dropna().distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of ids that are copies of one another: law and writ by text, asset by digest."""
    rows = documents(spark, sf_dir)
    known = sketches(rows)
    similar = near_pairs(rows, known)
    a, b = (known.where("n > 0").select("kind", F.col("id").alias(f"id_{s}"), F.col("key").alias(s)).distinct() for s in "ab")
    between = similar.join(a, ["kind", "a"]).join(b, ["kind", "b"]).select("kind", "id_a", "id_b")
    same = a.join(b, (a["kind"] == b["kind"]) & (a["a"] == b["b"])).select(a["kind"], "id_a", "id_b")
    assets = _assets(spark, sf_dir)
    copies = assets.withColumnRenamed("asset_id", "id_a").join(assets.withColumnRenamed("asset_id", "id_b"), "sha")
    both = between.unionAll(same).unionAll(copies.select(F.lit("asset").alias("kind"), "id_a", "id_b")).where("id_a <> id_b")
    return both.select(F.col("kind").alias("record_kind"), F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per law and writ text and per asset: the class of equal texts or digests and its number of similar classes."""
    rows = documents(spark, sf_dir)
    known = sketches(rows)
    similar = near_pairs(rows, known)
    ends = similar.select("kind", F.col("a").alias("key")).unionAll(similar.select("kind", F.col("b").alias("key")))
    links = ends.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("links"))
    texts = known.select("kind", "id", "key").distinct().join(links, ["kind", "key"], "left")
    assets = _assets(spark, sf_dir).select(F.lit("asset").alias("kind"), F.col("asset_id").alias("id"), F.col("sha").alias("key"), F.lit(0).alias("links"))
    return texts.unionByName(assets).select(
        F.col("kind").alias("record_kind"), F.col("id").alias("record_id"), F.col("key").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links")
    )


QUERIES = {"p2_found": p2_found, "p2_classes": p2_classes}
