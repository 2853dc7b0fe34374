"""Problem 1: main bodies of pages, by union-free wrappers of the pages of a host.

A page is a stream of line tokens. Digits are slots, and in short lines with separators
everything behind the first word is a text slot, so ``上一篇：<text>`` or a position line is
one token on every page. The wrapper of a host is a union-free expression over tokens:

* ``squared``: a token, or a row of up to three, that comes again at once is one repeated group;
* ``Wrapper.fold``: a page is aligned with the wrapper so far, in order, along as many
  tokens as possible; a token that only one of the two has becomes an optional group in its
  place, and a line whose text differs under one token becomes a text slot of that token;
* ``Wrapper.merge``: wrappers of parts of a host's pages are aligned with one another alike;
* ``Wrapper.settle``: tokens that too few pages share are no groups; they melt into text
  slots between the groups that are left.

Every task folds its own pages, so only wrappers are shuffled, and these are merged in
rounds of bounded groups; a host of any size is in no single task. Tokens that other hosts
have nearly as often are the language's, not the host's. A page is then aligned with its
host's wrapper, in order: of the text slots between its groups the heaviest is the main
body, but for lines in it that align with groups themselves. The inference is repeated with the bodies of the round before taken out.

Results in special cases: null and blank texts, error pages and place-holders, and pages
that are site matter alone give no rows; repeated rows count once; a capture whose text
differs between rows is several pages; pages without a host share one wrapper per kind;
empty tables give no rows; extra columns are ignored; lines of any length are read whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.functions.html import html_fragment
from canonry.llm.p4_survivor import PLACE_HOLDER, PLACE_HOLDER_LENGTH
from canonry.session import cut, release, table

#: A fixed token is on this share of a host's pages, and this many times its share of all pages.
SUPPORT, LIFT, LEAST_PAGES = 0.08, 1.8, 3
ROUNDS = 2
#: Groups on less than this share of the pages folded so far become text slots: a quarter of the support asked in the end, so no group with that is lost.
SETTLE = SUPPORT / 4
#: Pages of a host that one task folds before it hands on their wrapper, lines that it holds, and wrappers of a host merged in one group.
FOLDED, HELD, MERGED = 4096, 1 << 20, 32
#: Tokens of wrappers that may be broadcast, 8 bytes each; more are joined, big hosts by parts of so many pages.
BROADCAST_TOKENS, PART_PAGES = 2_000_000, 20_000
#: What advertisements inside a body say.
ADVERT = re.compile(
    r"^(?:广告|推广|赞助内容|Advertisement|Sponsored|AD)$|^展开全文|^点击(?:订阅|关注|下载|查看更多)|(?:关注|订阅).{0,20}公众号|^Subscribe to\b|^Read more\b"
    r"|^(?:延伸阅读|推荐阅读|相关阅读|热门文章|最新发布|热点推荐|Related links|Related|See also)\s*[：:].+",
    re.IGNORECASE,
)
_ADVERT_HEAD = re.compile(r"^(?:广告|推广|赞助内容|Advertisement|Sponsored|AD)$", re.IGNORECASE)
_SPLIT = re.compile(r"([：:|｜/»>→·•　\]\[]|\s{2,}| [-–—] )")
_DATE = re.compile(r"^\d{4}\s*年\s*\d{1,2}\s*月\s*\d{1,2}\s*日$")
_HEADING = re.compile(r"^(?:第[一二三四五六七八九十百零\d]+[章节条款]|[一二三四五六七八九十]+、|[（(][一二三四五六七八九十\d]+[）)]|\d+[．.、])")
_NEIGHBOUR = re.compile(r"^(?:上一[篇条页]|下一[篇条页]|Previous|Next)\s*[：:]")
_COUNTER = re.compile(r"(?:阅读量|浏览量|点击数|访问量|Views)\s*[:：]?\s*\d+")
_TRIM = " \t\r\n\x0b\x0c\x85\xa0　​﻿"
_SENTENCE = re.compile(r"[。；！？]$|[。；！？].*[。；！？：:]$|[.;!?][”\"’)]?$")
_PLACE = re.compile(PLACE_HOLDER)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def tokens(line: str) -> tuple[int, int]:
    """A line's token with digits as slots, and the one with text slots behind its first word."""
    masked = re.sub(r"\d+", "#", line)
    whole = _hash(masked)
    if len(line) > 160:
        return whole, whole
    parts = _SPLIT.split(masked)
    if len(parts) == 1:
        return whole, whole
    first = next((i for i, p in enumerate(parts) if p.strip(_TRIM)), 0)
    slots = ["".join(parts[: first + 1])]
    for p in parts[first + 1 :]:
        slots.append(p.strip() or "_" if _SPLIT.fullmatch(p) else "~" if p.strip(_TRIM) else "")
    # Repeated groups: a row of slots with one separator counts once.
    return whole, _hash(re.sub(r"((?:~.)+)(?=~)", lambda m: m.group(1)[:2], "".join(slots)))


def _body_weight(line: str) -> float:
    """How much a line that is no fixed token speaks for the main body."""
    if _DATE.match(line):
        return 2.0
    if _NEIGHBOUR.match(line) or _COUNTER.search(line):
        return -1.5
    if line.startswith("- ") and not _SENTENCE.search(line):
        return -0.7  # an item of a list in markup
    if _SENTENCE.search(line):
        return 3.5 if len(line) >= 10 else 2.0
    if len(line) >= 80:
        return 2.0
    if _HEADING.match(line):
        return 2.0
    return 0.3


def _pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for kind, key, host, text in zip(batch.kind, batch.id, batch.host, batch.text, strict=True):
            bare = text.strip(_TRIM)
            if not bare or (len(bare) <= PLACE_HOLDER_LENGTH and _PLACE.match(" ".join(bare.split()))):
                continue
            lines = [(i, s) for i, x in enumerate(text.split("\n")) if (s := x.strip(_TRIM))]
            pair = [tokens(s) for _, s in lines]
            advert, ad_before = [], False
            for _, s in lines:
                hit = ADVERT.search(s) is not None
                advert.append(hit or (ad_before and not _SENTENCE.search(s) and len(s) < 60 and re.search("[：:]", s) is not None))
                ad_before = _ADVERT_HEAD.match(s) is not None
            place = [len(s) <= PLACE_HOLDER_LENGTH and _PLACE.match(s) is not None for _, s in lines]
            rows.append(
                (kind, key, _hash(text), host, [i for i, _ in lines], [a for a, _ in pair], [b for _, b in pair], [_body_weight(s) for _, s in lines], advert, place)
            )
        yield pd.DataFrame(rows, columns=["kind", "id", "version", "host", "line", "whole", "slotted", "weight", "advert", "place"])


_PAGE = "kind string, id string, version bigint, host string, line array<int>, whole array<bigint>, slotted array<bigint>, weight array<float>, advert array<boolean>, place array<boolean>"


def squared(keys: list[int]) -> tuple[list[int], list[bool]]:
    """Positions kept of a stream in which rows of one to three tokens that come again at once count once; whether each is in such a group."""
    kept: list[int] = []
    again: list[bool] = []
    for i, k in enumerate(keys):
        kept.append(i)
        again.append(False)
        for width in (1, 2, 3):
            if len(kept) >= 2 * width and all(keys[kept[-x]] == keys[kept[-x - width]] for x in range(1, width + 1)):
                del kept[-width:], again[-width:]
                again[-width:] = [True] * width
                break
    return kept, again


def longest(stream: list[int], places: dict[int, list[int]]) -> list[tuple[int, int]]:
    """The longest alignment in order: (position in the stream, place), ``places`` by token."""
    tails: list[int] = []
    chain: list[tuple[int, int, int]] = []  # position, place, link before
    last: list[int] = []
    for i, token in enumerate(stream):
        for at in reversed(places.get(token, ())):
            k = bisect_left(tails, at)
            chain.append((i, at, last[k - 1] if k else -1))
            if k == len(tails):
                tails.append(at)
                last.append(len(chain) - 1)
            else:
                tails[k], last[k] = at, len(chain) - 1
    out, x = [], last[-1] if last else -1
    while x >= 0:
        i, at, x = chain[x]
        out.append((i, at))
    return out[::-1]


class Wrapper:
    """Groups in order: token, the text under it (0: a text slot), pages that have it, pages that repeat it."""

    def __init__(self) -> None:
        self.pages = 0
        self.groups: list[tuple[int, int, int, int]] = []

    def _aligned(self, other: list[tuple[int, int, int, int]]) -> None:
        places: dict[int, list[int]] = defaultdict(list)
        for at, g in enumerate(self.groups):
            places[g[0]].append(at)
        out, i, j = [], 0, 0
        for x, y in [*longest([g[0] for g in other], places), (len(other), len(self.groups))]:
            # Mismatches on either side: optional groups in their place.
            out += self.groups[j:y]
            out += other[i:x]
            if x < len(other):
                a, b = self.groups[y], other[x]
                out.append((a[0], a[1] if a[1] == b[1] else 0, a[2] + b[2], a[3] + b[3]))
            i, j = x + 1, y + 1
        self.groups = out

    def fold(self, keys: list[int], wholes: list[int]) -> None:
        """Aligns a page, given by the tokens of its lines and their texts."""
        kept, again = squared(keys)
        self._aligned([(keys[i], wholes[i], 1, int(r)) for i, r in zip(kept, again, strict=True)])
        self.pages += 1

    def merge(self, pages: int, groups: list[tuple[int, int, int, int]]) -> None:
        """Aligns the wrapper of other pages."""
        self._aligned(groups)
        self.pages += pages

    def settle(self) -> None:
        """Groups of too few pages become text slots."""
        on = Counter()
        for g in self.groups:
            on[g[0]] += g[2]
        self.groups = [g for g in self.groups if on[g[0]] >= SETTLE * self.pages]


_WRAPPER = "kind string, host string, pages bigint, token array<bigint>, whole array<bigint>, support array<bigint>, again array<bigint>"


def _wrapper_rows(wrappers: Iterable[tuple[tuple[str, str], Wrapper]]) -> pd.DataFrame:
    rows = [(*key, w.pages, *(list(x) for x in zip(*w.groups, strict=True))) if w.groups else (*key, w.pages, [], [], [], []) for key, w in wrappers]
    return pd.DataFrame(rows, columns=["kind", "host", "pages", "token", "whole", "support", "again"])


def _folded(pages: dict[tuple[str, str], list[tuple[list[int], list[int]]]]) -> pd.DataFrame:
    done = []
    for key, streams in pages.items():
        w = Wrapper()
        # A token of too few of these pages would settle at once; with it left out, a slot is there from the start.
        on = Counter(t for keys, _ in streams for t in set(keys))
        least = SETTLE * len(streams)
        for keys, wholes in streams:
            own = [i for i, t in enumerate(keys) if on[t] >= least]
            w.fold([keys[i] for i in own], [wholes[i] for i in own])
        w.settle()
        done.append((key, w))
    return _wrapper_rows(done)


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Wrappers of the hosts of one task, out of the lines outside the bodies of the round before."""
    held: dict = defaultdict(list)
    size = 0
    for batch in batches:
        for kind, host, whole, slotted, begin, end in zip(batch.kind, batch.host, batch.whole, batch.slotted, batch.begin, batch.end, strict=True):
            keys, wholes = slotted.tolist(), whole.tolist()
            if begin < end:
                del keys[begin:end], wholes[begin:end]
            held[kind, host].append((keys, wholes))
            size += len(keys)
            if len(held[kind, host]) >= FOLDED:
                yield _folded({(kind, host): held.pop((kind, host))})
        if size >= HELD:
            yield _folded(held)
            held, size = defaultdict(list), 0
    if held:
        yield _folded(held)


def _merge(parts: pd.DataFrame) -> pd.DataFrame:
    w = Wrapper()
    # The order decides which optional group comes first: that of the most pages, then by content.
    order = sorted(parts.itertuples(index=False), key=lambda r: (-r.pages, list(r.token)))
    for r in order:
        w.merge(r.pages, list(zip(r.token.tolist(), r.whole.tolist(), r.support.tolist(), r.again.tolist(), strict=True)))
    w.settle()
    return _wrapper_rows([((parts.kind.iloc[0], parts.host.iloc[0]), w)])


def inferred(pages: DataFrame) -> DataFrame:
    """The wrapper of each host: kind, host, pages and the groups' arrays."""
    parts = cut(pages.select("kind", "host", "whole", "slotted", "begin", "end").mapInPandas(_fold, _WRAPPER))
    while True:
        counts = parts.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("parts"))
        most = counts.agg(F.max("parts")).first()[0] or 1
        if most == 1:
            return parts
        salts = F.ceil(F.col("parts") / MERGED).cast("int")
        salted = parts.join(counts, ["kind", "host"]).withColumn("salt", F.pmod(F.xxhash64("pages", "token", "support"), salts))
        before, parts = parts, cut(salted.drop("parts").groupBy("kind", "host", "salt").applyInPandas(lambda g: _merge(g), _WRAPPER))
        release(before)


def wrappers(pages: DataFrame) -> DataFrame:
    """kind, host and, in order, the tokens of the wrapper of each host that has one."""
    every = inferred(pages)
    at = every.select("kind", "host", "pages", F.posexplode(F.arrays_zip("token", "whole", "support")).alias("at", "x")).select("kind", "host", "pages", "at", "x.*")
    each = at.select("kind", "host", "pages", F.explode(F.array_distinct(F.array("token", "whole"))).alias("token"), "support").where("token <> 0")
    by_host = each.groupBy("kind", "host", "token").agg(F.first("pages").alias("pages"), F.sum("support").alias("hits")).withColumn("hits", F.least("hits", "pages")).where(F.col("hits") >= LEAST_PAGES)
    everywhere = by_host.groupBy("kind", "token").agg(F.sum("hits").alias("all_hits"))
    total = every.groupBy("kind").agg(F.sum("pages").alias("all_pages"))
    share = F.col("hits") / F.col("pages")
    # Leave the host itself out of what is usual, so a host with most pages has a wrapper, too.
    elsewhere = F.greatest((F.col("all_hits") - F.col("hits")) / F.greatest(F.col("all_pages") - F.col("pages"), F.lit(1)), F.lit(0.0))
    own = by_host.join(everywhere, ["kind", "token"]).join(F.broadcast(total), "kind")  # a row per kind
    own = own.where((share >= SUPPORT) & (share >= LIFT * elsewhere)).select("kind", "host", "token")
    # A group stands under its token where that is the host's own, else under its text.
    either = at.select("kind", "host", "at", F.explode(F.array(F.struct(F.lit(0).alias("rank"), F.col("token").alias("token")), F.struct(F.lit(1).alias("rank"), F.col("whole").alias("token")))).alias("x")).select("kind", "host", "at", "x.*")
    kept = either.join(own, ["kind", "host", "token"]).groupBy("kind", "host", "at").agg(F.min_by("token", "rank").alias("token"))
    made = cut(kept.groupBy("kind", "host").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "token"))), lambda x: x["token"]).alias("wrapper")))
    release(every)
    return made


def body(weight: np.ndarray, fixed: np.ndarray) -> tuple[int, int]:
    """First line of the body and the one behind its last: the heaviest stretch of lines, of
    which the wrapper's groups weigh against a body. Equal ends where no line speaks for one."""
    gain = np.concatenate([[0.0], np.cumsum(np.where(fixed, -3.0, weight))])
    low = np.minimum.accumulate(gain)
    b = int(np.argmax(gain - low))
    if gain[b] <= low[b]:
        return 0, 0
    return int(np.flatnonzero(gain[: b + 1] == low[b])[-1]), b


def grouped(whole: list[int], slotted: list[int], places: dict[int, list[int]]) -> np.ndarray:
    """Which lines of a page align, in order, with groups of the wrapper; groups may come again."""
    stream = [s if s in places else w for w, s in zip(whole, slotted, strict=True)]
    out = np.zeros(len(stream), bool)
    while True:
        hits = [i for i, _ in longest([0 if out[i] else t for i, t in enumerate(stream)], places)]
        if not hits:
            return out
        out[hits] = True


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[tuple[str, str], dict[int, list[int]]] = {}
    for batch in batches:
        begins, ends, marked = [], [], []
        for kind, host, whole, slotted, weight, wrapper in zip(batch.kind, batch.host, batch.whole, batch.slotted, batch.weight, batch.wrapper, strict=True):
            if (places := known.get((kind, host))) is None:
                places = defaultdict(list)
                for at, t in enumerate(wrapper if wrapper is not None else ()):
                    places[int(t)].append(at)
                known = known if len(known) < 1000 else {}
                places = known[kind, host] = dict(places)
            fixed = grouped(whole.tolist(), slotted.tolist(), places) if places else np.zeros(len(whole), bool)
            a, b = body(np.asarray(weight, float), fixed)
            begins.append(a)
            ends.append(b)
            marked.append(fixed.tolist())
        yield batch.drop(columns=["wrapper"]).assign(begin=begins, end=ends, grouped=marked)


def aligned(pages: DataFrame, fixed: DataFrame) -> DataFrame:
    """Pages with begin and end of the body, and which lines are groups of the host's wrapper."""
    tokens_held = fixed.agg(F.sum(F.size("wrapper"))).first()[0] or 0
    bare = pages.drop("begin", "end", "grouped")
    if tokens_held <= BROADCAST_TOKENS:
        both = bare.join(F.broadcast(fixed), ["kind", "host"], "left")
    else:  # hosts with many pages by parts
        parts = pages.groupBy("kind", "host").agg(F.ceil(F.count(F.lit(1)) / PART_PAGES).cast("int").alias("parts"))
        spread = fixed.join(parts, ["kind", "host"]).select("kind", "host", "wrapper", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        salted = bare.join(F.broadcast(parts.where("parts > 1")), ["kind", "host"], "left")  # fewer hosts than pages / PART_PAGES
        salted = salted.withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
        both = salted.join(spread, ["kind", "host", "part"], "left").drop("part")
    return both.select(*bare.columns, "wrapper").mapInPandas(_align, f"{_PAGE}, begin int, end int, grouped array<boolean>")


def settled(rows: DataFrame) -> DataFrame:
    """Pages of rows (kind, id, host, text) that have a main body: its begin and end, and the
    lines with whether they are the site's."""
    pages = rows.where("text is not null and id is not null").mapInPandas(_pages, _PAGE).dropDuplicates(["kind", "id", "version"])
    pages = cut(pages.withColumns({"begin": F.lit(0), "end": F.lit(0)}))
    for _ in range(ROUNDS):
        before, fixed = pages, wrappers(pages)
        pages = cut(aligned(pages, fixed))
        release(before, fixed)
    x = pages.where("begin < end")
    inside = F.slice("place", F.col("begin") + 1, F.col("end") - F.col("begin"))
    outside = lambda y, at: (at < F.col("begin")) | (at >= F.col("end")) | y["advert"] | y["grouped"]
    lines = F.transform(F.arrays_zip("line", "advert", "grouped"), lambda y, at: F.struct(y["line"].alias("line_no"), outside(y, at).alias("site")))
    return x.where(~F.forall(inside, lambda y: y)).select("kind", "id", "version", lines.alias("lines"))


def site_lines(rows: DataFrame) -> DataFrame:
    """(kind, id, line_no) of the site's lines of pages (kind, id, host, text)."""
    each = settled(rows).select("kind", "id", F.explode("lines").alias("y"))
    return each.where("y.site").select("kind", "id", "y.line_no").distinct()


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for kind, key, version, kept, text in zip(batch.kind, batch.id, batch.version, batch.kept, batch.text, strict=True):
            if _hash(text) == version:
                lines = text.split("\n")
                rows.append((kind, key, "\n".join(lines[i].strip(_TRIM) for i in kept)))
        yield pd.DataFrame(rows, columns=["kind", "id", "body"])


def bodies(rows: DataFrame) -> DataFrame:
    """(kind, id, body) of pages that have a main body: its lines, trimmed, blank ones left out."""
    kept = settled(rows).select("kind", "id", "version", F.transform(F.filter("lines", lambda y: ~y["site"]), lambda y: y["line_no"]).alias("kept"))
    both = kept.join(rows.where("text is not null").select("kind", "id", "text").distinct(), ["kind", "id"])
    return both.mapInPandas(_kept, "kind string, id string, body string").distinct()


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = lambda url: F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))
    source = table(spark, sf_dir, "source_record").select(
        F.lit("source").alias("kind"), F.col("capture_id").alias("id"), host(F.col("source.page_url")).alias("host"), F.col("content.plain_text").alias("text")
    )
    writ = table(spark, sf_dir, "writ_document").select(F.lit("writ").alias("kind"), F.col("writ_id").alias("id"), host(F.col("source.page_url")).alias("host"), F.col("body").alias("text"))
    return source.unionAll(writ)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each page that belong to the site."""
    return site_lines(page_rows(spark, sf_dir)).select(F.col("kind").alias("record_kind"), F.col("id").alias("record_id"), "line_no")


def p1_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main bodies of pages: of plain texts, of markup (kind ``html``) and of decisions."""
    source = table(spark, sf_dir, "source_record").where("content.html is not null")
    host = F.coalesce(F.lower(F.regexp_extract("source.page_url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))
    markup = source.select(F.lit("html").alias("kind"), F.col("capture_id").alias("id"), host.alias("host"), F.replace(html_fragment(F.col("content.html"))["markdown"], F.lit("\n\n"), F.lit("\n")).alias("text"))
    found = bodies(cut(page_rows(spark, sf_dir).unionAll(markup)))
    return found.select(F.col("kind").alias("record_kind"), F.col("id").alias("record_id"), "body")


QUERIES = {"p1_found": p1_found, "p1_bodies": p1_bodies}
