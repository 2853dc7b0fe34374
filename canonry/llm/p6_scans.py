"""Problem 6: noise in text from scanned pages.

Page numbers are lines of one form whose values count up through a text; running headers
are lines that begin pages and, digits masked and confusable glyphs replaced by one of
their group, recur. Words and characters are grouped by this skeleton over the whole
corpus; a form is misread where a far more frequent form of its group stands in the same
context (for words the word itself, for Chinese characters their neighbours). A hyphen at
a line end is noise unless the corpus writes the word with it. Paragraphs are reflowed by
SQL windows over the remaining lines.

Results in special cases: null and blank texts give no row; clean texts have no noise; a
text of one page has a page number only as its last line; repeated rows count once; a file
of several assets gives the rows of each; assets without a text give none; empty tables
give no rows; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canonry.session import cut, release, table

#: Groups of Chinese characters that scanners take for one another.
GLYPHS = (
    "的旳", "资贫", "人入", "由田", "在仕", "会佘", "账帐", "期朗", "市巿", "同冋", "业亚", "基墓", "日曰", "理埋", "内肉", "不个", "应庒", "券劵", "未末", "已己", "第笫",
    "土士", "千干", "天夭", "治冶", "大太", "微徵", "候侯", "拨拔", "折拆", "辨辩", "货贷", "侍待", "徒徙",
)
#: Latin glyphs and pairs that scanners take for one another, and what stands for them; single ones first, so pairs are found in whatever stands for them.
LATIN = (
    ("1", "l"), ("|", "l"), ("0", "o"), ("5", "s"), ("9", "g"), ("8", "b"), ("6", "b"), ("'", "f"), ("q", "g"), ("e", "c"),
    ("rn", "m"), ("vv", "w"), ("ii", "u"), ("ti", "u"), ("li", "h"), ("cl", "d"), ("i", "l"),
)
#: Strokes such as ``tii`` or ``lii`` can be two glyphs in several ways: the orders in which pairs are replaced.
READINGS = tuple((*LATIN[:12], *pairs, *LATIN[15:]) for pairs in ((("ii", "u"), ("ti", "u"), ("li", "h")), (("li", "h"), ("ii", "u"), ("ti", "u")), (("ti", "ii"), ("ii", "u"), ("li", "h"))))
#: Bytes, measured, up to which what the corpus says of words goes to all workers; beyond that every text gets what concerns it by a join.
FORMS_BYTES = 32 << 20
#: Times that a dominating form, or a word whose own hyphen is in doubt, must be written.
DOMINATES, COMMON = 20, 50
#: A form is misread with less than this share of the form that dominates its group.
DOMINATED = 0.03
#: Odds by which the neighbours must prefer another character.
CONTEXT_ODDS = 60.0
_GLYPH_GROUP = {c: g[0] for g in GLYPHS for c in g}
_D = "[0-9OoIl|]{1,4}"
_PAGE_FORMS = [
    re.compile(p)
    for p in (
        rf"^({_D})$", rf"^[-–—]\s*({_D})\s*[-–—]$", rf"^[·•]\s*({_D})\s*[·•]$", rf"^[\[【(（]\s*({_D})\s*[\]】)）]$", rf"^第\s*({_D})\s*页(?:\s*[/，,]?\s*共\s*{_D}\s*页)?$",
        rf"^[Pp][Aa][Gg][Ee]\s*({_D})(?:\s*(?:of|/)\s*{_D})?$", rf"^({_D})\s*/\s*{_D}$", r"^([ivxlc]{1,7})$", rf"^[~～*]\s*({_D})\s*[~～*]$", rf"^[Pp]\.\s*({_D})$",
    )
]
_WORD = re.compile(r"[A-Za-z0-9|](?:[A-Za-z0-9|']*[A-Za-z0-9|])?(?:-[A-Za-z0-9|](?:[A-Za-z0-9|']*[A-Za-z0-9|])?)*")
_HYPHENS = "-‐‑¬\xad"
_CLOSED = re.compile(r"[。！？：；，、.!?:;,]$")
_INSIDE = re.compile(r"[。，；]|[,;] ")
_HEADING = re.compile(r"^(?:[第笫][一二三四五六七八九十百]+[章节条]|Article|Chapter|[一二三四五六七八九十]+、|[（(]?[一二三四五六七八九十\d]+[）).．])")
_GARBLED = re.compile(r"[\x80-\xbf\ufffd\ue000-\uf8ff\uff61-\uff9f]|[\xc0-\xff]{2}")
_NUMBERED = re.compile(r"　\d{1,4}$")
_DIGIT_ODD = re.compile(r"(?<![A-Za-z0-9])(?=[0-9OoIl]*[0-9])(?=[0-9OoIl]*[OoIl])[0-9OoIl]{2,}(?![A-Za-z0-9])")


def _roman(s: str) -> int:
    v = [{"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}[c] for c in s]
    return sum(-a if b > a else a for a, b in zip(v, [*v[1:], 0], strict=True))


def skeleton(word: str) -> str:
    """A Latin word with one glyph of each confusable group, lower case."""
    return _stands_for(word, LATIN)


def _stands_for(word: str, glyphs: tuple[tuple[str, str], ...]) -> str:
    w = word.lower()
    for a, b in glyphs:
        w = w.replace(a, b)
    return w


def skeletons(word: str) -> str:
    """A word's skeleton in every reading, each once, joined by line feeds."""
    return "\n".join(dict.fromkeys(_stands_for(word, r) for r in READINGS))


def _page_number(line: str) -> tuple[int, int] | None:
    for form, p in enumerate(_PAGE_FORMS):
        if m := p.match(line):
            s = m.group(1)
            if form == 7:
                return form, _roman(s)
            s = s.translate(str.maketrans("OoIl|", "00111"))
            return form, int(s)
    return None


def _alike(a: str, b: str) -> bool:
    """Whether two masked lines are one header: equal, one cut off or with a tail, or a few characters misread."""
    x, y = sorted((a, b), key=len)
    if len(x) < 5:
        return False
    if y.startswith(x):
        return True
    if len(y) - len(x) <= 4 and SequenceMatcher(None, x, y, False).ratio() >= 0.8:
        return True
    return len(y) > len(x) and SequenceMatcher(None, x, y[: len(x)], False).ratio() >= 0.85


def _recurring(masked: list[str]) -> set[str]:
    """Forms of 3 to 90 characters that come again among the lines that begin pages, if not equal, then alike.

    Only different forms are compared, and only with those that share a piece of three
    characters (two, if short), as forms that are alike always do.
    """
    n = Counter(masked)
    again = {m for m, k in n.items() if k > 1 and 3 <= len(m) <= 90}
    by_piece: dict[str, list[str]] = defaultdict(list)
    for m in n:
        if len(m) >= 5:
            for piece in {m[i : i + 3] for i in range(len(m) - 2)} | ({m[i : i + 2] for i in range(len(m) - 1)} if len(m) < 10 else set()):
                by_piece[piece].append(m)
    for m in n:
        if m in again or not 5 <= len(m) <= 90:
            continue
        others = {o for i in range(len(m) - 1) for width in (2, 3) for o in by_piece.get(m[i : i + width], ()) if o != m}
        if any(_alike(m, o) for o in others):
            again.add(m)
    return again


def furniture(lines: list[str]) -> set[int]:
    """Numbers of the lines that are page numbers or running headers."""
    bare = [x.strip(" \t\r\x0c　\xa0") for x in lines]
    filled = [i for i, x in enumerate(bare) if x]
    if not filled:
        return set()
    order = {i: k for k, i in enumerate(filled)}
    by_form: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i in filled:
        if len(bare[i]) <= 24 and (hit := _page_number(bare[i])):
            by_form[hit[0]].append((i, hit[1]))
    pages: set[int] = set()
    for form, hits in by_form.items():
        for (i, v), (j, u) in zip(hits, hits[1:]):
            if 1 <= u - v <= 2 and order[j] - order[i] >= 3:
                pages |= {i, j}
        # A misread number between two others, or one at an end, still counts by its place.
        if len(hits) >= 2 and not pages and form in (1, 2, 4, 5) and all(order[b[0]] - order[a[0]] >= 3 for a, b in zip(hits, hits[1:])):
            pages |= {i for i, _ in hits}
    for hits in by_form.values():
        pages |= {i for i, _ in hits if order[i] + 1 < len(filled) and lines[filled[order[i] + 1]].startswith("\x0c")}
    last = filled[-1]
    if not pages and len(filled) >= 4 and any(h[0] == last for hs in by_form.values() for h in hs) and not _page_number(bare[filled[-2]]):
        pages.add(last)
    if pages and last not in pages and len(bare[last]) <= 24 and _page_number(bare[last]) and filled[-2] not in pages:
        pages.add(last)
    starts = [filled[0]]
    for i in filled[1:]:
        before = filled[order[i] - 1]
        if before in pages or lines[i].startswith("\x0c") or any(lines[k].strip(" \t\r　\xa0") == "\x0c" for k in range(before + 1, i)):
            if i not in pages:
                starts.append(i)
    heads = set()
    if len(starts) > 1:
        masked = [_mask(bare[i]) for i in starts]
        again = _recurring(masked)
        heads = {i for i, m in zip(starts, masked, strict=True) if m in again}
    # Alternating or single headers: short lines at a page's begin that no sentence or heading explains.
    lengths = sorted(len(bare[i]) for i in filled if i not in pages)
    open_lines = sum(not _CLOSED.search(bare[i]) for i in filled if i not in pages)
    if len(lengths) >= 4 and open_lines * 2 > len(lengths):
        width = lengths[int(len(lengths) * 0.8)]
        for i in starts if width <= 90 else ():
            x = bare[i]
            if len(x) > 60 or _GARBLED.search(x):
                continue
            if i not in heads and 3 <= len(x) < 0.8 * width and not _CLOSED.search(x) and not _INSIDE.search(x) and not _HEADING.match(x):
                heads.add(i)
            elif i not in heads and _NUMBERED.search(x) and not _INSIDE.search(x):
                heads.add(i)
    return pages | heads | _strays(bare, filled, pages | heads, heads)


def _mask(line: str) -> str:
    return "".join(_GLYPH_GROUP.get(c, c) for c in re.sub(r"[0-9OoIl|]+", "#", line))


def _strays(bare: list[str], filled: list[int], known: set[int], heads: set[int]) -> set[int]:
    """Headers of pages whose number is lost: lines like a known header, and short lines that come
    again and break into a sentence. The signature at a text's end is none."""
    forms = {m for i in heads if len(m := _mask(bare[i])) >= 5}
    rest = [(k, i) for k, i in enumerate(filled) if i not in known and 5 <= len(bare[i]) <= 60]
    masked = {i: _mask(bare[i]) for _, i in rest}
    lengths = sorted(len(bare[i]) for i in filled if i not in known)
    width = lengths[int(len(lengths) * 0.8)] if lengths else 0
    times = Counter(masked.values())

    def breaks_in(k: int) -> bool:
        return 0 < k < len(filled) - 1 and not _CLOSED.search(bare[filled[k - 1]]) and filled[k - 1] not in known

    def plain(i: int) -> bool:
        return not (_CLOSED.search(bare[i]) or _INSIDE.search(bare[i]) or _HEADING.match(bare[i]) or _GARBLED.search(bare[i]))

    again = {masked[i] for k, i in rest if times[masked[i]] > 1 and len(bare[i]) < 0.8 * width and breaks_in(k) and plain(i)}
    out = set()
    for k, i in rest:
        m = masked[i]
        # No more than 0.2 of a form and one character can be without a match, so no more of its characters can be missing.
        like = m in forms or any(abs(len(m) - len(f)) <= 2 and len(set(f) - set(m)) <= 0.2 * len(f) + 1 and SequenceMatcher(None, m, f, False).ratio() >= 0.8 for f in forms)
        signature = k >= len(filled) - 2 and not breaks_in(k)
        if (like or m in again) and not signature:
            out.add(i)
    return out


def _body(text: str) -> tuple[list[tuple[int, str]], set[int]]:
    """Lines of the body (number, stripped) and the furniture of a text."""
    lines = text.split("\n")
    site = furniture(lines)
    return [(i, s) for i, x in enumerate(lines) if i not in site and (s := x.strip(" \t\r\x0c　\xa0"))], site


def _ends(body: list[tuple[int, str]]) -> Iterator[tuple[int, str, str, str]]:
    """Of each body line with a hyphen at its end and a word on both sides: its place, the parts, the hyphen."""
    for k in range(len(body) - 1):
        s = body[k][1]
        if len(s) >= 2 and s[-1] in _HYPHENS:
            left = re.search(r"([A-Za-z0-9|'][A-Za-z0-9|'-]*)$", s[:-1])
            right = re.match(r"[A-Za-z0-9|'](?:[A-Za-z0-9|'-]*[A-Za-z0-9|])?", body[k + 1][1])
            if left and right:
                yield k, left.group(1), right.group(0), s[-1]


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts: words and their skeletons (what w; with n = 0 where they are only asked
    for), words broken at line ends (h), and neighbours of confusable characters (l, r)."""
    for batch in batches:
        words, n, ends = Counter(), Counter(), set()
        for text in batch.text:
            body, _ = _body(text)
            words.update(w.lower() for w in _WORD.findall("\n".join(s for _, s in body)) if not w.isdigit())
            for _, a, b, _ in _ends(body):
                ends.add((a.lower(), b.lower()))
            code = np.frombuffer("".join(s for _, s in body).encode("utf-32-le", "surrogatepass"), np.uint32)
            for what, c, beside in zip("lr", *_neighbours(code), strict=True):
                n.update((what, *x) for x in zip(c.tolist(), beside.tolist(), strict=True))
        for w in [w for w in words if "-" in w]:
            for part in w.split("-"):
                words[part] += 0
        for a, b in ends:
            words[a + b] += 0
            words[b.split("-")[0]] += 0
            words[a] += 0
        rows = [("w", w, skeletons(w), None, None, 0, 0, k) for w, k in words.items()]
        rows += [("h", a, b, skeleton(f"{a}-{b.split('-')[0]}"), skeleton(a + b.split("-")[0]), 0, 0, 1) for a, b in ends]
        rows += [(what, None, None, None, None, c, o, k) for (what, c, o), k in n.items()]
        yield pd.DataFrame(rows, columns=["what", "form", "other", "hyphened", "joined", "c", "beside", "n"])


_COUNTS = "what string, form string, other string, hyphened string, joined string, c int, beside int, n bigint"
_GLYPH_CODES = np.array(sorted(map(ord, _GLYPH_GROUP)), np.uint32)
#: The other character of the group of each of _GLYPH_CODES; groups are pairs.
_GLYPH_OTHER = np.array([next(ord(o) for g in GLYPHS if c in g for o in g if o != c) for c in map(chr, _GLYPH_CODES.tolist())], np.int64)

_GLYPH_FIRST = np.array([ord(_GLYPH_GROUP[c]) for c in map(chr, _GLYPH_CODES.tolist())], np.int64)


def _glyphs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of confusable characters, and the ones before and behind each (0 at the ends)."""
    at = np.searchsorted(_GLYPH_CODES, code)
    at[at == len(_GLYPH_CODES)] = 0
    places = np.flatnonzero(_GLYPH_CODES[at] == code) if len(code) else np.empty(0, np.int64)
    # A neighbour may be misread itself: of each group the first character stands for all.
    one = np.where(_GLYPH_CODES[at] == code, _GLYPH_FIRST[at], code.astype(np.int64)) if len(code) else code.astype(np.int64)
    padded = np.concatenate([[0], one, [0]]).astype(np.int64)
    return places, padded[places], padded[places + 2]


def _neighbours(code: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    places, before, after = _glyphs(code)
    c = code[places].astype(np.int64)
    return (c, c), (before, after)


class Beside:
    """How often a confusable character has a neighbour: pairs as numbers, sorted."""

    def __init__(self, c: np.ndarray, beside: np.ndarray, n: np.ndarray) -> None:
        keys = c.astype(np.int64) << 21 | beside.astype(np.int64)
        order = np.argsort(keys)
        self.keys, self.n = keys[order], n[order].astype(np.float64)

    def __call__(self, c: np.ndarray, beside: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(c))
        keys = c << 21 | beside
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.n[at], 0.0)


class Forms:
    """What the corpus says: misread words and what is right, compounds that are right although
    a part of them isn't, pairs of word parts that are written with a hyphen, and neighbours."""

    def __init__(self, wrong: dict[str, str], right: set[str], own: set[tuple[str, str]], left: Beside, beside: Beside) -> None:
        self.wrong, self.right, self.own, self.left, self.beside = wrong, right, own, left, beside

    def word_right(self, word: str) -> str | None:
        """The dominating form of a misread word, else null."""
        return self.wrong.get(word.lower())

    def misread(self, word: str) -> bool:
        """Whether a word, or a part of a compound that isn't known to be right, is misread."""
        w = word.lower()
        return w in self.wrong or ("-" in w and w not in self.right and any(p in self.wrong for p in w.split("-")))

    def own_hyphen(self, left: str, right: str) -> bool:
        """Whether the corpus writes the two parts as one word with a hyphen."""
        return (left.lower(), right.lower().split("-")[0]) in self.own

    def glyphs_right(self, code: np.ndarray) -> dict[int, str]:
        """Places of misread characters and the ones that their neighbours prefer by far."""
        places, before, after = _glyphs(code)
        c = code[places].astype(np.int64)
        other = _GLYPH_OTHER[np.searchsorted(_GLYPH_CODES, c)]
        own = (self.left(c, before) + 0.5) * (self.beside(c, after) + 0.5)
        far = (self.left(other, before) + 0.5) * (self.beside(other, after) + 0.5) >= CONTEXT_ODDS * own
        return dict(zip(places[far].tolist(), map(chr, other[far].tolist()), strict=True))


def _broken(body: list[tuple[int, str]], forms: Forms) -> dict[int, tuple[str, str]]:
    """The parts of the words that line breaking split, by the body line that ends with the first."""
    return {k: (a, b) for k, a, b, hyphen in _ends(body) if hyphen not in "-‑" or not forms.own_hyphen(a, b)}


def _misread_glyphs(body: list[tuple[int, str]], forms: Forms) -> dict[tuple[int, int], str]:
    """By body line and place in it, what a misread character should be."""
    code = np.frombuffer("".join(s for _, s in body).encode("utf-32-le", "surrogatepass"), np.uint32)
    start = np.cumsum([0, *(len(s) for _, s in body)])
    out = {}
    for at, c in forms.glyphs_right(code).items():
        k = int(np.searchsorted(start, at, side="right")) - 1
        out[k, at - int(start[k])] = c
    return out


def noise(text: str, forms: Forms) -> list[tuple[int, str]]:
    """(line, noise) of a text."""
    body, site = _body(text)
    out = {(i, "furniture") for i in site}
    ends = _broken(body, forms)
    out |= {(body[k][0], "hyphen") for k in ends}
    for k, (i, s) in enumerate(body):
        head = len(ends[k - 1][1]) if k - 1 in ends else 0
        tail = len(s) - 1 - len(ends[k][0]) if k in ends else len(s)
        inner = s[head:tail] if tail >= head else ""
        if _DIGIT_ODD.search(s) or any(map(forms.misread, _WORD.findall(inner))):
            out.add((i, "misread"))
        if k in ends and (best := forms.word_right("".join(ends[k]))):
            a = ends[k][0].lower()
            at = i if not best.startswith(a) else body[k + 1][0]
            out.add((at, "misread"))
    out |= {(body[k][0], "misread") for k, _ in _misread_glyphs(body, forms)}
    return sorted(out)


def repaired(text: str, forms: Forms) -> list[tuple[int, str, bool]]:
    """(line, repaired text, joined to the next without a blank) of the body lines."""
    body, _ = _body(text)
    fixed = [list(s) for _, s in body]
    for (k, at), c in _misread_glyphs(body, forms).items():
        fixed[k][at] = c
    ends, out = _broken(body, forms), []
    for k, s in enumerate("".join(x) for x in fixed):
        s = _WORD.sub(lambda m: forms.word_right(m.group(0)) or m.group(0), s[:-1] if k in ends else s)
        s = _DIGIT_ODD.sub(lambda m: m.group(0).translate(str.maketrans("OoIl", "0011")), s)
        out.append((body[k][0], s, k in ends))
    return out


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kind, id, text of rule texts and of the files of assets."""
    law = table(spark, sf_dir, "law_document").select(F.lit("law").alias("kind"), F.col("law_id").alias("id"), F.col("full_text").alias("text"))
    files = table(spark, sf_dir, "asset_text").select("local_file", F.col("plain_text").alias("text"))
    return law.unionAll(files.select(F.lit("asset").alias("kind"), F.col("local_file").alias("id"), "text")).where("id is not null and length(trim(text)) > 0")


def learned(rows: DataFrame) -> tuple[DataFrame, Beside, Beside]:
    """What all texts say of words, as a table (what, key, value), and of neighbours.

    In the table, m has misread words with their right form, r compounds that are right
    although a part is misread, o word parts (joined by a line feed) written with a hyphen.
    Neighbours have a row for each confusable character and character there is, so at most
    some 70 times the characters of all scripts, 16 bytes each.
    """
    kept = ["what", "form", "other", "hyphened", "joined", "c", "beside"]
    n = cut(rows.select("text").mapInPandas(_counts, _COUNTS).groupBy(*kept).agg(F.sum("n").alias("n")))
    words = n.where("what = 'w'").select(F.col("form").alias("word"), F.col("other").alias("skeleton"), "n")
    each = words.select("word", "n", F.explode(F.split("skeleton", "\n")).alias("skeleton"))
    groups = each.groupBy("skeleton").agg(F.sum("n").alias("total"), F.max(F.struct("n", "word")).alias("best"))
    dominated = (F.col("best.n") >= DOMINATES) & (F.col("best.word") != F.col("word")) & (F.col("n") < DOMINATED * F.col("best.n"))
    wrong = each.join(groups, "skeleton").where(dominated & (F.length("word") >= 2) & ~F.col("word").rlike("^[0-9]+$"))
    wrong = cut(wrong.groupBy("word").agg(F.max("best").alias("best")).select("word", F.col("best.word").alias("right")))
    compounds = words.where((F.instr("word", "-") > 0) & (F.col("n") >= 2)).select("word", F.explode(F.split("word", "-")).alias("part"))
    known = compounds.join(wrong.select(F.col("word").alias("part")), "part", "left_semi").select("word").distinct()
    of = lambda key: groups.select(F.col("skeleton").alias(key), F.col("total").alias(f"n_{key}"))
    often = words.where(F.col("n") > COMMON)
    pairs = n.where("what = 'h'").select(F.col("form").alias("a"), F.split("other", "-")[0].alias("b"), "hyphened", "joined").distinct()
    pairs = pairs.join(of("hyphened"), "hyphened", "left").join(of("joined"), "joined", "left").join(often.select(F.col("word").alias("a"), F.lit(True).alias("often_a")), "a", "left").join(often.select(F.col("word").alias("b"), F.lit(True).alias("often_b")), "b", "left")
    with_it, without = F.coalesce("n_hyphened", F.lit(0)), F.coalesce("n_joined", F.lit(0))
    own = pairs.where(F.when(with_it + without > 0, with_it > without).otherwise(F.col("often_a").isNotNull() & F.col("often_b").isNotNull()))
    none = F.lit(None).cast("string")
    facts = wrong.select(F.lit("m").alias("what"), F.col("word").alias("key"), F.col("right").alias("value")).unionAll(known.select(F.lit("r"), "word", none)).unionAll(own.select(F.lit("o"), F.concat_ws("\n", "a", "b"), none))
    facts = cut(facts)
    beside = n.where("what in ('l', 'r')").select("what", "c", "beside", "n").toPandas()
    left, right = (Beside(x.c.to_numpy(), x.beside.to_numpy(), x.n.to_numpy()) for x in (beside[beside.what == w] for w in "lr"))
    release(n, wrong)
    return facts, left, right


def _facts(rows: Iterable[tuple[str, str, str | None]], left: Beside, right: Beside) -> Forms:
    rows = list(rows)
    return Forms({k: v for w, k, v in rows if w == "m"}, {k for w, k, _ in rows if w == "r"}, {tuple(k.split("\n")) for w, k, _ in rows if w == "o"}, left, right)


def learn(rows: DataFrame) -> Forms:
    """All that is learned, in one object; for texts whose facts are few."""
    facts, left, right = learned(rows)
    return _facts(map(tuple, facts.collect()), left, right)


def _asks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The keys of facts that a text can ask for."""
    for batch in batches:
        out = []
        for kind, key, version, text in zip(batch.kind, batch.id, batch.version, batch.text, strict=True):
            body, _ = _body(text)
            words = {w.lower() for w in _WORD.findall("\n".join(s for _, s in body))}
            ends = {(a.lower(), b.lower()) for _, a, b, _ in _ends(body)}
            parts = words | {p for w in words for p in w.split("-")} | {a + b for a, b in ends}
            out += [(kind, key, version, "m", w) for w in parts] + [(kind, key, version, "r", w) for w in words if "-" in w]
            out += [(kind, key, version, "o", f"{a}\n{b.split('-')[0]}") for a, b in ends]
        yield pd.DataFrame(out, columns=["kind", "id", "version", "what", "key"])


def applied(rows: DataFrame, of_text: Callable[[str, Forms], list[tuple]], columns: list[str], schema: str) -> DataFrame:
    """What ``of_text`` gives of each text, with kind, id and version (of the texts of one id)."""
    rows = rows.select("kind", "id", F.xxhash64("text").alias("version"), "text")
    facts, left, right = learned(rows)
    sc = rows.sparkSession.sparkContext
    held = facts.agg(F.sum(F.length("key") + F.coalesce(F.length("value"), F.lit(0)) + 100)).first()[0] or 0
    if held <= FORMS_BYTES:
        forms = sc.broadcast(_facts(map(tuple, facts.collect()), left, right))
        own = rows
    else:
        forms = sc.broadcast(_facts([], left, right))
        asked = rows.mapInPandas(_asks, "kind string, id string, version bigint, what string, key string").distinct()
        told = asked.join(facts, ["what", "key"]).groupBy("kind", "id", "version").agg(F.collect_list(F.struct("what", "key", "value")).alias("facts"))
        own = rows.join(told, ["kind", "id", "version"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            every = [None] * len(batch) if "facts" not in batch else batch.facts
            out = []
            for kind, key, version, text, told in zip(batch.kind, batch.id, batch.version, batch.text, every, strict=True):
                f = forms.value if told is None else _facts(((x["what"], x["key"], x["value"]) for x in told), forms.value.left, forms.value.beside)
                out += [(kind, key, version, *x) for x in of_text(text, f)]
            yield pd.DataFrame(out, columns=["kind", "id", "version", *columns])

    return own.mapInPandas(run, f"kind string, id string, version bigint, {schema}")


def _assets_of(spark: SparkSession, sf_dir: str, found: DataFrame) -> DataFrame:
    """Rows (kind, id, ...) with the ids of the assets instead of their files."""
    own = table(spark, sf_dir, "asset_record").select("asset_id", F.col("local_file").alias("id")).dropna().distinct()
    asset = found.where("kind = 'asset'").join(own, "id").drop("id").withColumnRenamed("asset_id", "id")
    return found.where("kind = 'law'").unionByName(asset)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with furniture, hyphens of line breaking and misread characters."""
    found = applied(texts(spark, sf_dir), noise, ["line_no", "noise"], "line_no int, noise string").drop("version")
    found = cut(found.distinct())
    return _assets_of(spark, sf_dir, found).select(F.col("kind").alias("record_kind"), F.col("id").alias("record_id"), "line_no", "noise").distinct()


def p6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repaired text of each record, as continuous paragraphs; an id with several texts has several versions."""
    lines = applied(texts(spark, sf_dir), repaired, ["line_no", "line", "split"], "line_no int, line string, split boolean").distinct()
    order = W.partitionBy("kind", "id", "version").orderBy("line_no")
    before, was_split = F.lag("line").over(order), F.coalesce(F.lag("split").over(order), F.lit(False))
    fresh = before.isNull() | (before.rlike(r"[。！？：；.!?:;][”’\"')）]*$") & ~was_split) | F.col("line").rlike(r"^(?:第[一二三四五六七八九十百]+[章节条]|Article \d|Chapter \d|[一二三四五六七八九十]+、|\d+\. )")
    gap = F.when(was_split | F.right(before, F.lit(1)).rlike(r"\p{IsHan}|[，、；：（《“]") | F.col("line").rlike(r"^[\p{IsHan}，。、；：）》”]"), F.lit("")).otherwise(F.lit(" "))
    marked = lines.withColumn("fresh", fresh.cast("int")).withColumn("piece", F.concat(F.when(fresh, F.lit("")).otherwise(gap), F.col("line")))
    numbered = marked.withColumn("paragraph", F.sum("fresh").over(order.rowsBetween(W.unboundedPreceding, 0)))
    whole = numbered.groupBy("kind", "id", "version", "paragraph").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "piece"))), lambda x: x["piece"]), "").alias("text"))
    return _assets_of(spark, sf_dir, whole).select(F.col("kind").alias("record_kind"), F.col("id").alias("record_id"), "version", "paragraph", "text")


QUERIES = {"p6_found": p6_found, "p6_paragraphs": p6_paragraphs}
