"""Problem 10: text quality statistics per document, and what isn't running prose.

Word, symbol, bullet, punctuation, line and common-word statistics are counted for many
texts at once: the code points of a batch are one array, a table gives the classes of each,
and running sums give the counts between any two line ends. One pass over the table, no
shuffle.
Fixed-threshold rules, of the kind published for web corpora (mean word length, symbol
ratio, share of bullet lines, share of lines ending in punctuation, stop words,
repetition) are applied to the statistics of every line and of the document, and a reason
is recorded for every failure, for lines with the share of characters that fail so.
Reasons of lines belong to a kind (list, table, junk); a document whose failures of all
kinds weigh more than two thirds gets a reason for the heaviest kind, and p10_found is read
off these reasons.

Results in special cases: null, empty and blank texts have zero counts, null ratios, no
reasons and no row in p10_found; a text of any length is one row; equal texts under other
ids are rows of their own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.session import table

#: A kind needs more than this share of a text's characters.
MAJORITY = 2 / 3
#: Common words of English and characters of Chinese.
COMMON_EN = "the|of|and|to|a|in|is|be|it|that|for|by|on|as|with|are|or|an|at|from|this|not|must|has|have|its|which|when|but|before"
COMMON_ZH = "的一是不在人有为以于上和与时及由应其或可者所不得当将被等对从后前"
#: Fixed thresholds' names: what a line fails by, in the order they are tried, and the kind of text that such lines make.
REASONS = {
    "ruled_line": "table", "unbroken_run": "junk", "program_or_log": "junk", "repetition": "junk", "cells": "table", "symbols": "junk", "few_vowels": "junk", "uncommon_characters": "junk",
    "words_without_sentence": "junk", "short_item": "list",
}
KINDS = ("list", "table", "junk")
#: Code points counted at once; bounds the memory of a batch, not the length of a text.
BLOCK = 1 << 20
_BULLET = re.compile(r"(?:[•·◦▪■□●○◆*+>‣–—-]\s*|[(（\[【]?(?:\d{1,4}|[a-zA-Z]|[一二三四五六七八九十]{1,4})[)）\]】.、．]\s*)\S")
_CODE = re.compile(r"function\s*\w*\(|\bvar\s|\breturn\b|\bdef\s+\w+\(|</?\w+[^>]*>|\w+\([^)]*\)\s*[;{]|#include|=>|::")
_LOG = re.compile(r"(?:^|\s)(?:ERROR|WARN|INFO|DEBUG|FATAL|TRACE)\b|^\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d")
_COMMON = re.compile(rf"\b(?:{COMMON_EN})\b", re.IGNORECASE)
_CLASSES = ("alnum", "han", "latin", "vowel", "digit", "space", "bar", "common", "mark", "symbol", "trim", "run", "brace")


_ITEM, _PROSE, _HEADLINE = len(REASONS) - 1, len(REASONS), len(REASONS) + 1


@cache
def _classes() -> np.ndarray:
    """Bits of the classes of every code point."""
    table = np.zeros(0x110000, np.uint16)
    bit = {name: np.uint16(1 << i) for i, name in enumerate(_CLASSES)}
    for c in range(0x110000):
        k = unicodedata.category(chr(c))
        if k[0] in "LN":
            table[c] |= bit["alnum"]
        elif k[0] == "S" or k == "Co":
            table[c] |= bit["symbol"]
        elif k == "Zs":
            table[c] |= bit["trim"]

    def put(name: str, chars: str) -> None:
        table[[ord(x) for x in chars]] |= bit[name]

    for a, b in ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)):
        table[a : b + 1] |= bit["han"]
    letters = "".join(chr(c) for c in range(65, 91)) + "".join(chr(c) for c in range(97, 123))
    put("latin", letters)
    put("vowel", "AEIOUYaeiouy")
    put("digit", "0123456789")
    put("space", " \t")
    put("bar", "|｜\t")
    put("common", COMMON_ZH)
    put("mark", "。！？，；")
    put("symbol", "#*_%@\\{}[]<>~^&=+|/")
    put("trim", " \t\r\x0b\x0c\u200b\ufeff")
    put("run", letters + "0123456789+/=_%-")
    put("brace", "{}();=<>")
    return table


def _block(texts: list[str]) -> pd.DataFrame:
    """The line facts of some texts: document number, reason of failure, characters, bullet, ends; and counts."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(code)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    doc_end = np.cumsum(lengths)
    cls = _classes()[np.minimum(code, 0x10FFFF)]
    after = np.append(code[1:], np.uint32(10)) if n else code
    sums = {}

    def running(bits: np.ndarray) -> np.ndarray:
        out = np.zeros(n + 1, np.int32)
        np.cumsum(bits, out=out[1:])
        return out

    for i, name in enumerate(_CLASSES):
        sums[name] = running((cls >> i) & 1)
    blank_after = (after == 32) | (after == 10) | (after == 9) | (after == 13)
    sums["stop"] = running((((cls >> _CLASSES.index("mark")) & 1) == 1) | (np.isin(code, [46, 44, 59, 33, 63]) & blank_after))
    sums["comma"] = running((code == 44) & (after != 32))
    sums["semi"] = running((code == 59) & (after != 32))
    three = (code == 32) & (after == 32)
    three[:-1] &= three[1:]
    first = three.copy()
    first[1:] &= code[:-1] != 32
    sums["gap"] = running(first)
    word = ((cls & 1) == 1) & ((cls & 2) == 0)
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    sums["word"] = running(begins)
    # Lines: between line feeds and ends of texts, without outer blanks.
    ends = np.union1d(np.flatnonzero(code == 10), doc_end)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    starts += (starts < n) & (code[np.minimum(starts, max(n - 1, 0))] == 10) if n else 0
    starts = np.minimum(starts, ends)
    solid = np.flatnonzero(((cls >> _CLASSES.index("trim")) & 1 == 0) & (code != 10))
    lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    kept = hi > lo
    a, b = solid[lo[kept]], solid[hi[kept] - 1] + 1
    line = pd.DataFrame({"doc": np.searchsorted(doc_end, a, side="right"), "n": b - a, **{k: v[b] - v[a] for k, v in sums.items()}})
    joined = "".join(texts)
    text = [joined[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    closing = np.frombuffer("".join(t.rstrip("”\"’』」）)] ")[-1:] or " " for t in text).encode("utf-32-le", "surrogatepass"), np.uint32)
    line["ends"] = np.isin(closing, [ord(c) for c in "。！？!?…；;：:，,."])
    line["bullet"] = [_BULLET.match(t) is not None for t in text]
    line["common_en"] = [len(_COMMON.findall(t)) if m else 0 for t, m in zip(text, line.latin.to_numpy() > 3, strict=True)]
    program = [
        (x * 12 > m and _CODE.search(t) is not None) or (d > 8 and _LOG.search(t) is not None)
        for t, m, x, d in zip(text, line.n, line.brace, line.digit, strict=True)
    ]
    dense = [m >= 60 and s * 80 < m and len(zlib.compress(t.encode("utf-8", "replace"), 6)) < 16 + 0.12 * len(t.encode("utf-8", "replace")) for t, m, s in zip(text, line.n, line.stop, strict=True)]
    spelled = [not t.strip("-|:+= \t") for t in text]
    x = line
    cells_tight = np.maximum(np.maximum(x.comma, x.semi), x.gap)
    words = x.space + 1
    symbols = x.alnum * 2 < x.n
    run_on = (x.n >= 60) & (x.run * 20 >= x.n * 19) & (x.space * 30 <= x.n)
    vowelless = (x.latin * 2 > x.n) & (x.latin > 20) & (x.vowel * 6 < x.latin)
    strange = (x.han * 2 > x.n) & (x.han > 20) & (x.common * 60 < x.han) & (x.stop * 60 < x.n)
    menu = (x.stop == 0) & (words >= 8) & (x.common_en * 12 < words) & (x.n > 60) & (x.bar == 0) & (cells_tight < 2)
    row = ((x.bar >= 1) & (x.n < (x.bar + 1) * 24)) | (
        (cells_tight >= 2) & (x.n < (cells_tight + 1) * 22) & (x.mark == 0) & ((x.n < (cells_tight + 1) * 12) | (x.digit * 5 > x.n) | (x.stop <= cells_tight))
    )
    short = np.where(x.han * 2 > x.alnum, x.n <= 48, x.n <= 130)
    item = (~x.ends | (x.bullet & (x.stop <= 1) & (x.n < 60))) & short & (((x.stop <= 1) & ((x.common_en * 5 < words) | x.bullet | (x.han > 0))) | (x.n < 12))
    program, dense, ruled = np.array(program, bool), np.array(dense, bool), np.array(spelled, bool) & (x.bar > 0)
    failed = [ruled, run_on, program, dense, row & (x.alnum * 3 > x.n), (symbols & ~x.bullet) | (x.alnum * 3 < x.n), vowelless, strange, menu, item]
    line["reason"] = np.select(failed, range(len(REASONS)), _PROSE) if len(line) else np.empty(0, int)
    # A headline over other lines belongs to no kind.
    top = ~line.doc.duplicated() & line.doc.duplicated(keep=False)
    line.loc[top & ~line.ends & ~line.bullet & line.reason.isin([_ITEM, _PROSE]) & (line.n <= 160), "reason"] = _HEADLINE
    return line


_RATIOS = ("mean_word_length", "symbol_ratio", "bullet_share", "ended_share", "common_share", "prose_share", *REASONS)
_SCHEMA = "doc_id bigint, n_chars bigint, n_lines bigint, n_words bigint, " + ", ".join(f"{c} double" for c in _RATIOS)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch.text.fillna("").tolist()
        parts, at, size = [], 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= BLOCK or i == len(texts) - 1:
                parts.append(_of_documents(batch.doc_id.iloc[at : i + 1], texts[at : i + 1]))
                at, size = i + 1, 0
        if parts:
            yield pd.concat(parts)


def _of_documents(ids: pd.Series, texts: list[str]) -> pd.DataFrame:
    line = _block(texts)
    m = len(texts)
    total = lambda w: np.bincount(line.doc, w, m)
    n_lines = np.bincount(line.doc, minlength=m)
    words, chars = total(line.han + line.word), np.fromiter(map(len, texts), np.int64, m)
    weighed = total(line.n.where(line.reason != _HEADLINE, 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        out = {
            "doc_id": ids.to_numpy(), "n_chars": chars, "n_lines": n_lines, "n_words": words.astype(np.int64), "mean_word_length": total(line.alnum) / words,
            "symbol_ratio": total(line.symbol) / chars, "bullet_share": total(line.bullet) / n_lines, "ended_share": total(line.ends) / n_lines,
            "common_share": total(line.common + line.common_en) / words,
            **{name: total(line.n.where(line.reason == k, 0)) / weighed for k, name in enumerate((*REASONS, "prose_share"))},
        }
    return pd.DataFrame(out).replace([np.inf, -np.inf], np.nan)


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: the statistics, the shares of kinds, what lines fail by, with the
    share of characters that do (``failures``), and the reasons the document fails by."""
    out = docs.select("doc_id", "text").mapInPandas(_count, _SCHEMA)
    out = out.select("doc_id", "n_chars", "n_lines", "n_words", *(F.when(~F.isnan(c), F.col(c)).alias(c) for c in _RATIOS))
    failures = F.filter(F.array(*(F.struct(F.lit(r).alias("reason"), F.lit(kind).alias("kind"), F.col(r).alias("share")) for r, kind in REASONS.items())), lambda x: x["share"] > 0)
    out = out.withColumn("failures", F.when(F.col("n_lines") > 0, failures).otherwise(F.slice(failures, 1, 0))).drop(*REASONS)
    for kind in KINDS:
        of_kind = F.filter("failures", _is(kind))
        out = out.withColumn(f"{kind}_share", F.when(F.col("n_lines") > 0, F.aggregate(of_kind, F.lit(0.0), lambda t, x: t + x["share"])))
    failed = lambda c, reason: F.when(c, F.lit(reason))
    shares = [F.col(f"{k}_share") for k in KINDS]
    top, other = F.greatest(*shares), sum(shares[1:], shares[0])
    heaviest = F.when(F.col("junk_share") == top, "junk").when(F.col("table_share") == top, "table").otherwise("list")
    reasons = F.array_compact(
        F.array(
            failed(F.col("n_words") < 5, "few_words"), failed(~F.col("mean_word_length").between(1, 10), "word_length"), failed(F.col("symbol_ratio") > 0.1, "many_symbols"),
            failed(F.col("bullet_share") > 0.9, "bullets"), failed(F.col("ended_share") < 0.3, "no_punctuation"), failed(F.col("common_share") < 0.05, "few_common_words"),
            F.when(other > MAJORITY, heaviest),
        )
    )
    out = out.withColumn("reasons", F.when(F.col("n_lines") > 0, reasons).otherwise(F.array().cast("array<string>")))
    for c in (*_RATIOS[:6], *(f"{k}_share" for k in KINDS)):
        out = out.withColumn(c, F.round(c, 6))
    return out.withColumn("failures", F.transform("failures", lambda x: F.struct(x["reason"].alias("reason"), F.round(x["share"], 6).alias("share"))))


def kinds(stats: DataFrame) -> DataFrame:
    """doc_id and text_kind of the documents that fail as a whole kind, by their reasons."""
    of_kind = F.filter("reasons", lambda x: x.isin(*KINDS))
    return stats.where(F.size(of_kind) > 0).select("doc_id", of_kind[0].alias("text_kind"))


def p10_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics and reasons of each document."""
    return statistics(table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are mostly a list, a table or junk."""
    return kinds(statistics(table(spark, sf_dir, "documents")))


QUERIES = {"p10_found": p10_found, "p10_stats": p10_stats}
