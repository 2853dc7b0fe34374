"""Problem 9: evaluation texts leaking into training text, by winnowing.

Both texts are brought into compatibility form, lower-cased and reduced to letters and
digits. Of every window of W hashes of K-character sequences the least is kept, so any
shared run of K + W - 1 characters, the shortest that counts, shares at least one kept
hash. Kept hashes of documents and items are joined; every hit is extended to both sides
along its diagonal, and runs of sufficient length cover characters of the item.

Results in special cases: null and empty texts, and texts shorter than a run, give no row;
whole-text copies under other ids are rows of their own; of an item_id with several texts
each counts for itself; items of a language other than zh follow the rule for en; empty
tables give no rows; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.session import cut, table

#: Shortest run, sequence and window, by rule: run = sequence + window - 1.
RULES = {"zh": (24, 20, 5), "en": (80, 64, 17)}
SHARE = 0.4
#: Distinct hashes of items that may be broadcast, 8 bytes each, to drop all other hashes of
#: documents before they are shuffled. With more items all kept hashes go into the join.
FILTER_HASHES = 4_000_000
#: Rows of items' kept hashes, repeated ones included, that may be broadcast to the join, about 40 bytes each; more are joined by a shuffle.
BROADCAST_PRINTS = 400_000
#: Characters hashed at once; bounds memory only.
BLOCK = 1 << 21
_OTHER = re.compile(r"[\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def reduced(text: str | None) -> str:
    """Compatibility form, lower case, letters and digits only."""
    return _OTHER.sub("", unicodedata.normalize("NFKC", text).lower()) if text else ""


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours, by doubling."""
    f, have, out = (np.minimum if least else np.maximum), 1, x
    while have * 2 <= width:
        out = f(out[:-have], out[have:])
        have *= 2
    return f(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def winnow(code: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes that are the least of some window of w sequences of k characters."""
    if len(code) < k + w - 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    # Hashes of k characters from those of powers of two.
    piece, power, size, at, out = code.astype(np.uint64) + np.uint64(1), _BASE, 1, 0, None
    with np.errstate(over="ignore"):
        rest, n = k, len(code) - k + 1
        while rest:
            if rest & 1:
                part = piece[at : at + n]
                out = part if out is None else out * power + part
                at += size
            rest >>= 1
            if rest:
                piece = piece[:-size] * power + piece[size:]
                power = power * power
                size *= 2
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    low = _slide(out, w, True)
    edge = np.zeros(w - 1, np.uint64)
    chosen = np.flatnonzero(_slide(np.concatenate([edge, low, edge]), w, False) == out)
    return chosen, out[chosen]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for item, lang, text in zip(batch.item_id, batch.lang, batch.text, strict=True):
            rule = "zh" if str(lang or "").lower().startswith("zh") else "en"
            body = reduced(text)
            at, h = winnow(_codes(body), *RULES[rule][1:])
            rows.append((item, rule, body, h.view(np.int64), at))
        yield pd.DataFrame(rows, columns=["item_id", "rule", "body", "hashes", "places"])


def _documents(batches: Iterator[pd.DataFrame], wanted: dict[str, np.ndarray] | None) -> Iterator[pd.DataFrame]:
    for batch in batches:
        bodies = [reduced(t) for t in batch.text]
        ids = batch.doc_id.to_numpy()
        at = 0
        while at < len(bodies):
            end, size = at, 0
            while end < len(bodies) and (end == at or size + len(bodies[end]) < BLOCK):
                size += len(bodies[end]) + 1
                end += 1
            part = bodies[at:end]
            code = np.concatenate([np.append(_codes(b), np.uint32(0x110000)) for b in part])
            start = np.concatenate([[0], np.cumsum([len(b) + 1 for b in part])])
            found: dict[int, list] = {}
            for rule, (_, k, w) in RULES.items():
                pos, h = winnow(code, k, w)
                if wanted is not None:
                    keys = wanted.get(rule, np.empty(0, np.uint64))
                    near = np.searchsorted(keys, h)
                    ok = (near < len(keys)) if len(keys) else np.zeros(len(h), bool)
                    ok[ok] = keys[near[ok]] == h[ok]
                    pos, h = pos[ok], h[ok]
                doc = np.searchsorted(start, pos, side="right") - 1
                inside = pos + k <= start[doc + 1] - 1
                for d, p, v in zip(doc[inside].tolist(), (pos - start[doc])[inside].tolist(), h[inside].view(np.int64).tolist(), strict=True):
                    found.setdefault(d, []).append((rule, v, p))
            if found:
                yield pd.DataFrame(
                    [(ids[at + d], part[d], [{"rule": r, "hash": v, "place": p} for r, v, p in hits]) for d, hits in found.items()],
                    columns=["doc_id", "body", "hits"],
                )
            at = end


def covered(item: str, doc: str, diagonals: list[int], run: int) -> int:
    """Characters of the item that lie in runs shared with the document on these diagonals."""
    a, b = _codes(item), _codes(doc)
    seen = np.zeros(len(a), bool)
    for d in diagonals:  # place in the document less place in the item
        lo = max(0, -d)
        hi = max(lo, min(len(a), len(b) - d))
        same = np.concatenate([[False], a[lo:hi] == b[lo + d : hi + d], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2], edges[1::2], strict=True):
            if e - s >= run:
                seen[lo + s : lo + e] = True
    return int(seen.sum())


def _extend(batches: Iterator[pd.DataFrame], share: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = [
            len(item) > 0 and covered(item, doc, list(d), RULES[rule][0]) >= share * len(item) - 1e-9
            for item, doc, d, rule in zip(batch.item_body, batch.body, batch.diagonals, batch.rule, strict=True)
        ]
        yield batch.loc[keep, ["doc_id", "item_id"]]


def leaks(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id): documents (doc_id, text) that hold enough of an item (item_id, lang, text)."""
    spark = docs.sparkSession
    own = cut(items.select("item_id", "lang", "text").mapInPandas(_items, "item_id bigint, rule string, body string, hashes array<bigint>, places array<bigint>"))
    prints = own.select("item_id", "rule", F.xxhash64("body").alias("version"), F.explode(F.arrays_zip("hashes", "places")).alias("x")).select(
        "item_id", "version", "rule", F.col("x.hashes").alias("hash"), F.col("x.places").alias("item_place")
    )
    distinct = prints.select("rule", "hash").distinct()
    few = distinct.count() <= FILTER_HASHES
    wanted = None
    if few:
        held = distinct.toPandas()
        by_rule = {r: np.sort(g.hash.to_numpy(np.int64).view(np.uint64)) for r, g in held.groupby("rule")}
        wanted = spark.sparkContext.broadcast(by_rule)
    hit = cut(
        docs.select("doc_id", "text").mapInPandas(
            lambda it: _documents(it, wanted.value if wanted is not None else None), "doc_id bigint, body string, hits array<struct<rule: string, hash: bigint, place: int>>"
        )
    )
    seeds = hit.select("doc_id", F.explode("hits").alias("x")).select("doc_id", "x.*")
    met = seeds.join(F.broadcast(prints) if prints.count() <= BROADCAST_PRINTS else prints, ["rule", "hash"])
    pairs = met.groupBy("doc_id", "item_id", "version", "rule").agg(F.collect_set((F.col("place") - F.col("item_place")).cast("int")).alias("diagonals"))
    texts = own.select("item_id", F.xxhash64("body").alias("version"), F.col("body").alias("item_body")).distinct()
    both = pairs.join(texts, ["item_id", "version"]).join(hit.select("doc_id", "body").dropDuplicates(["doc_id"]), "doc_id")
    return both.mapInPandas(lambda it: _extend(it, share), "doc_id bigint, item_id bigint").distinct()


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the evaluation items that leaked into them."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


QUERIES = {"p9_found": p9_found}
