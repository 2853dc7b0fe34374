"""Problem 7: text decoded with the wrong encoding: found, and restored where it can be.

All clean records are garbled by every known chain of encodings, and a multinomial model
learns the hashed byte bigrams of the clean and of each garbled text: first from the records
without a doubt, then from all that the first model calls clean. Where a chain turns each
character into others by itself, the pairs of characters tell its bigrams; they are counted
once for all these chains. The tasks count, and only the sums come to the driver.
Every record that isn't ASCII is scanned for the stretches whose bigrams speak for one
chain against clean text; texts whose characters allow the same chains are scanned together.
The chain is inverted, and the stretch counts as garbled if it
decodes strictly and the result is so much likelier than the stretch as it stands, in its
place, that chance can't explain it. Likelihood comes from the characters and character
pairs of the clean records, and from scripts where a character is new: a run in one script,
as a foreign name, is likelier than one that jumps between scripts, as garble does. So a
short stretch, whose inversion may make sense by chance, needs as much evidence as a long
one. Only where bytes were lost (U+FFFD) do the pieces between them count instead, each
decoded as far as it goes, against the same measure.

Results in special cases: null, empty and blank values give no row; correct foreign
scripts, whose inversion fails or is less likely, give no row; repeated rows count once;
empty tables give no rows, also if there is nothing to learn from; texts are scanned
whole; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.session import table

#: Characters that a task counts at once, readings of short stretches that it keeps, and likelihoods of pairs.
AT_ONCE, KNOWN, KNOWN_PAIRS = 1 << 21, 1 << 16, 1 << 18
#: Texts of fewer characters are judged pair by pair; characters of texts that are looked at together.
SHORT, TOGETHER = 64, 1 << 15
#: Characters of the values that count as clean without a doubt, the marks and the Chinese ones of GB 2312.
SEED = frozenset("".join(bytes((a, b)).decode("gb2312", "ignore") for a in (0xA1, 0xA3, *range(0xB0, 0xF8)) for b in range(0xA1, 0xFF)) + "—–")
#: Hashed bigrams, smoothing, and the log odds a stretch needs.
BUCKETS, ALPHA, ODDS = 1 << 15, 0.05, 9.0
#: Log odds by which a restored stretch must be likelier than the one that stands there.
GAIN = 12.0
#: Log likelihood of a byte that stays undecodable.
LOST_COST = -6.0
#: Log odds of a lost byte itself: clean text has none.
LOST_GAIN = 8.0
#: Characters at either end of a stretch that may belong to its surroundings.
TRIM = 5
#: Chains, each as what the text was written in and taken for, by turns.
CHAINS = (
    ("utf-8", "latin-1"), ("utf-8", "cp1252"), ("utf-8", "gb18030"), ("utf-8", "big5"), ("utf-8", "cp932"), ("utf-8", "koi8-r"), ("utf-8", "cp1251"),
    ("gb18030", "latin-1"), ("gb18030", "cp1252"), ("gb18030", "big5"), ("gb18030", "cp932"), ("gb18030", "koi8-r"), ("gb18030", "cp1251"), ("gb18030", "euc-kr"),
    ("big5", "latin-1"), ("big5", "gb18030"),
    ("utf-8", "mac-roman"), ("utf-8", "cp437"), ("utf-8", "cp850"), ("utf-8", "cp1250"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "mac-roman"), ("mac-roman", "cp1252"),
    ("utf-8", "cp1252", "utf-8", "cp1252"), ("utf-8", "latin-1", "utf-8", "latin-1"), ("utf-8", "cp1252", "utf-8", "latin-1"),
)
_LOST, _ASCII = "�", "".join(map(chr, range(0x80)))
#: Chains that make characters out of the bytes of several; of all others the pairs of characters are enough.
JOINED = tuple(k for k, c in enumerate(CHAINS) if {"gb18030", "big5", "cp932", "euc-kr"} & set(c[1::2]))
#: What stands before and behind a text among the pairs of characters; the bits of one in a pair.
_END, _BITS = 0x110000, 21


#: As browsers do: bytes without a character stand for the control of that number.
_CP1252 = {b: c for b in range(0x80, 0xA0) if (c := bytes([b]).decode("cp1252", "ignore"))}
_CP1252_BACK = {ord(c): b for b, c in _CP1252.items()}


def _decode(data: bytes, codec: str) -> str:
    return data.decode("latin-1").translate(_CP1252) if codec == "cp1252" else data.decode(codec, "replace")


def _encode(text: str, codec: str, errors: str) -> bytes:
    if codec != "cp1252":
        return text.encode(codec, errors)
    try:
        return text.encode(codec)
    except UnicodeError:
        return text.translate(_CP1252_BACK).encode("latin-1", errors)


def _encodable(text: str, codec: str) -> bool:
    try:
        _encode(text, codec, "strict")
    except UnicodeError:
        return False
    return True


def garble(text: str, chain: tuple[str, ...]) -> str:
    for written, taken in zip(chain[::2], chain[1::2], strict=True):
        text = _decode(text.encode(written, "replace"), taken)
    return text


def invert(text: str, chain: tuple[str, ...], strict: bool = True) -> str | None:
    """The text before the chain; with ``strict`` null where a step is not exact."""
    try:
        for written, taken in reversed(list(zip(chain[::2], chain[1::2], strict=True))):
            text = _encode(text, taken, "strict" if strict else "replace").decode(written, "strict" if strict else "replace")
    except (UnicodeError, ValueError):
        return None
    return text


#: Chains of which one character is enough; all others turn one into several.
_SINGLE = sum(1 << k for k, c in enumerate(CHAINS) if c[0] not in ("utf-8", "gb18030", "big5"))


@cache
def _taken() -> np.ndarray:
    """Of every code point the chains, as bits, that it can come out of if it isn't ASCII; all for a lost one."""
    of_codec = {codec: np.zeros(0x10000, bool) for codec in {c[-1] for c in CHAINS}}
    pairs = [bytes((x, y)) for x in range(0x81, 0xFF) for y in (*range(0x40, 0x7F), *range(0x80, 0xFF))]
    for codec, mark in of_codec.items():
        if codec == "gb18030":
            mark[0x80:0xD800] = mark[0xE000:] = True
            continue
        data = [bytes((x,)) for x in range(0x80, 0x100)] + (pairs if codec in ("big5", "cp932", "euc-kr") else [])
        made = "".join(_decode(d, codec) if codec == "cp1252" else d.decode(codec, "ignore") for d in data)
        mark[[n for c in made if 0x80 <= (n := ord(c)) < 0x10000]] = True
    bits = np.zeros(0x110000, np.uint32)
    for k, chain in enumerate(CHAINS):
        bits[:0x10000] |= of_codec[chain[-1]].astype(np.uint32) << np.uint32(k)
    bits[ord(_LOST)] = (1 << len(CHAINS)) - 1
    bits[0x10000:] = bits[0xFFFF]
    return bits


def _chains(texts: list[str]) -> list[int]:
    """Of each text the chains, as bits, that can have a stretch in it: those that its characters, or two beside one another, come out of."""
    each = _taken().take(np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.int32))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    beside = np.append(each[:-1] & each[1:], np.uint32(0))
    return (np.bitwise_or.reduceat(each, begins) & np.uint32(_SINGLE) | np.bitwise_or.reduceat(beside, begins) & ~np.uint32(_SINGLE)).tolist()


def _bigrams(data: np.ndarray) -> np.ndarray:
    x = data.astype(np.uint32)
    return (((x[:-1] << 8) | x[1:]) * np.uint32(2654435761)) >> np.uint32(32 - 15)


#: Ranges of scripts and signs, how many characters each has in use, and the share of a text's changes of script that lead to it.
SCRIPTS = (
    ("ascii", 0x00, 0x7F, 95, 0.3), ("control", 0x80, 0x9F, 32, 0.0005), ("latin sign", 0xA0, 0xBF, 32, 0.01), ("latin upper", 0xC0, 0xDE, 31, 0.01), ("latin lower", 0xDF, 0xFF, 33, 0.02),
    ("latin more", 0x100, 0x24F, 300, 0.005), ("greek", 0x370, 0x3FF, 60, 0.01), ("cyrillic upper", 0x400, 0x42F, 34, 0.01), ("cyrillic lower", 0x430, 0x45F, 34, 0.01),
    ("mark", 0x2000, 0x206F, 40, 0.02), ("sign", 0x20A0, 0x24FF, 300, 0.01), ("box", 0x2500, 0x259F, 160, 0.001), ("sign", 0x25A0, 0x2BFF, 300, 0.01), ("cjk mark", 0x3000, 0x303F, 40, 0.1),
    ("hiragana", 0x3041, 0x309F, 86, 0.01), ("katakana", 0x30A0, 0x30FF, 90, 0.01), ("bopomofo", 0x3100, 0x33FF, 500, 0.002), ("hangul", 0xAC00, 0xD7A3, 2350, 0.01),
    ("private", 0xE000, 0xF8FF, 6400, 0.0005), ("wide", 0xFF01, 0xFF5E, 94, 0.05), ("half katakana", 0xFF61, 0xFF9F, 63, 0.002), ("lost", 0xFFFD, 0xFFFD, 1, 0.0001),
)
#: Weights of pairs, of characters and of scripts in the likelihood, and of a run staying in its script.
WEIGHTS, STAY = (0.6, 0.3, 0.1), 0.6


@cache
def _scripts() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point up to U+FFFF its script, the one whose small letters may follow, and the likelihoods of it where a script begins and within its script."""
    names, script, share = ["han", "han other", "rare"], np.full(0x10000, 2, np.int16), np.full(0x10000, 0.01 / 15000)
    for low, high in ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)):
        script[low : high + 1], share[low : high + 1] = 1, 0.05 / 15000
    level = np.array([a << 8 | b for a in range(0xA4, 0xC7) for b in (*range(0x40, 0x7F), *range(0xA1, 0xFF))], ">u2").tobytes().decode("big5", "ignore")
    share[[n for c in level if 0x4E00 <= (n := ord(c)) <= 0x9FFF]] = 0.05 / 5401
    seed = [ord(c) for c in SEED]
    script[seed], share[seed] = 0, 0.3 / 6763
    for name, low, high, n, part in SCRIPTS:
        if name not in names:
            names.append(name)
        script[low : high + 1], share[low : high + 1] = names.index(name), part / n
    of = dict(zip(names, (6763, 5401, 15000), strict=False)) | {name: n for name, _, _, n, _ in SCRIPTS}
    size = np.array([1 / of[n] for n in names])[script]
    small = np.array([names.index(n.replace("upper", "lower")) for n in names], np.int16)[script]
    return script, small, np.stack([share, size])


class CleanText:
    """How likely text is, by the characters, pairs and scripts of clean text."""

    def __init__(self, pairs: np.ndarray, n: np.ndarray) -> None:
        first, second = pairs >> _BITS, pairs & ((1 << _BITS) - 1)
        begins, inner = second != _END, (first != _END) & (second != _END)
        low = lambda x: np.minimum(x, 0xFFFF)
        self.single = np.bincount(low(second[begins]), n[begins], 0x10000)
        self.pairs, at = np.unique((low(first[inner]) << 16 | low(second[inner])).astype(np.uint32), return_inverse=True)
        self.counts = np.bincount(at, n[inner], len(self.pairs))
        self.share = self.single / max(1.0, self.single.sum())
        self.known: dict[str, float] = {}  # the likelihoods of pairs met in short texts

    @staticmethod
    def codes(text: str) -> np.ndarray:
        return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), np.uint32(0xFFFF))

    def log_p(self, text: str) -> np.ndarray:
        """Log likelihood of each character of a text but the first, behind the one before it."""
        if len(text) >= SHORT:
            return self._log_p(text)
        return np.array(self._known_log_p([text[i : i + 2] for i in range(len(text) - 1)]), np.float64)

    def _log_p(self, text: str) -> np.ndarray:
        code = self.codes(text)
        return self.pairs_log_p(code[:-1], code[1:])

    def _known_log_p(self, pairs: list[str]) -> list[float]:
        try:
            return [self.known[p] for p in pairs]
        except KeyError:
            if len(self.known) >= KNOWN_PAIRS:
                self.known.clear()
            code = self.codes("".join(pairs))
            log_p = self.pairs_log_p(code[::2], code[1::2]).tolist()
            self.known.update(zip(pairs, log_p, strict=True))
            return log_p

    def pairs_log_p(self, p: np.ndarray, c: np.ndarray) -> np.ndarray:
        pair, one, script = WEIGHTS
        of, small, (begins, among) = _scripts()
        stays = (of[p] == of[c]) | (small[p] == of[c])
        new = np.where(stays, STAY * among[c], (1 - STAY) * begins[c])
        seen = self.single[p]
        keys = p << np.uint32(16) | c
        at = np.minimum(np.searchsorted(self.pairs, keys), max(0, len(self.pairs) - 1))
        both = np.where(self.pairs[at] == keys, self.counts[at], 0) if len(self.pairs) else np.zeros(len(keys))
        # Nothing is known of what follows a character that is new itself, but its script.
        follows = np.where(seen > 0, pair * both / np.maximum(seen, 1) + script * new, (pair + script) * new)
        return np.log(follows + one * self.share[c])

    def gain(self, text: str, other: str) -> float:
        """By how much a text is likelier than another one of its length, but for rounding, from the pairs that differ."""
        x, y = self.codes(text), self.codes(other)
        differs = x != y
        at = np.flatnonzero(differs[:-1] | differs[1:])
        if len(at) < SHORT:
            return sum(self._known_log_p([text[i : i + 2] for i in at.tolist()])) - sum(self._known_log_p([other[i : i + 2] for i in at.tolist()]))
        return float(self.pairs_log_p(x[at], x[at + 1]).sum() - self.pairs_log_p(y[at], y[at + 1]).sum())


def _gains(odds: np.ndarray) -> np.ndarray:
    """By how much the running sum of odds, or of each row of them, is above its least before, at its begin and behind each."""
    sums = np.zeros((*odds.shape[:-1], odds.shape[-1] + 1))
    sums[..., 1:] = odds
    np.add.accumulate(sums, axis=-1, out=sums)
    sums -= np.minimum.accumulate(sums, axis=-1)
    return sums


def _risen(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the parts of a row of gains in which they reach ODDS; at the end they are at 0 again, or it is the row's."""
    edge = np.flatnonzero(np.diff(gain > 0))
    begins, ends = edge[::2], np.append(edge[1::2] + 1, len(gain))[: (len(edge) + 1) // 2]
    high = np.maximum.reduceat(gain, begins) >= ODDS
    return begins[high], ends[high]


class Counts(NamedTuple):
    """How often pairs of characters are in texts, and byte bigrams, as rows of JOINED, in texts garbled by these chains."""

    pairs: np.ndarray
    n: np.ndarray
    grams: np.ndarray

    def __add__(self, other: Counts) -> Counts:
        pairs, at = np.unique(np.concatenate([self.pairs, other.pairs]), return_inverse=True)
        n = np.bincount(at, np.concatenate([self.n, other.n]), len(pairs)).astype(np.int64)
        return Counts(pairs[n > 0], n[n > 0], self.grams + other.grams)


def _byte_pairs(texts: list[str]) -> np.ndarray:
    data = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-8", "replace"), np.uint8)
    return sum(np.bincount(data[i : i + (len(data) - i) // 2 * 2].view("<u2"), minlength=1 << 16) for i in (0, 1)).reshape(256, 256).T.ravel()


def _tally(texts: Iterable[str], weight: Callable[[str], int]) -> Iterator[pd.DataFrame]:
    return _weighed((t, weight(t)) for t in texts)


def _weighed(texts: Iterable[tuple[str, int]]) -> Iterator[pd.DataFrame]:
    """chain (-1: none, pairs of characters), gram, n: the counts of texts, each as often as its weight (1, 0 or -1) says."""
    grams, held, size = np.zeros((len(JOINED), 1 << 16), np.int64), {1: [], -1: []}, 0

    def pairs() -> Iterator[pd.DataFrame]:
        for sign, rows in held.items():
            if rows:
                code = np.frombuffer("\n".join(["", *rows, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
                code[np.cumsum([0, *(len(t) + 1 for t in rows)])] = _END
                for written in {CHAINS[k][0] for k in JOINED}:
                    data = [t.encode(written, "replace") for t in rows]
                    for i, k in enumerate(JOINED):
                        if CHAINS[k][0] == written:
                            grams[i] += sign * _byte_pairs([garble(_decode(d, CHAINS[k][1]), CHAINS[k][2:]) for d in data])
                both, n = np.unique(code[:-1] << _BITS | code[1:], return_counts=True)
                yield pd.DataFrame({"chain": -1, "gram": both, "n": sign * n})
            rows.clear()

    for text, sign in texts:
        if sign:
            held[sign].append(text)
            size += len(text)
        if size >= AT_ONCE:
            yield from pairs()
            size = 0
    yield from pairs()
    chain, gram = np.nonzero(grams)
    yield pd.DataFrame({"chain": chain, "gram": gram, "n": grams[chain, gram]})


def _counts(chain: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Counts:
    grams, one = np.zeros((len(JOINED), 1 << 16), np.int64), chain < 0
    np.add.at(grams, (chain[~one], gram[~one]), n[~one])
    pairs, at = np.unique(gram[one], return_inverse=True)
    return Counts(pairs, np.bincount(at, n[one], len(pairs)).astype(np.int64), grams)


def chain_counts(counts: Counts) -> np.ndarray:
    """How often each hashed bigram is in the counted texts as they are, in the first row, and garbled by each chain."""
    bucket = _bigrams(np.arange(1 << 16, dtype=">u2").view(np.uint8))[::2]
    codes, at = np.unique(np.concatenate([counts.pairs >> _BITS, counts.pairs & ((1 << _BITS) - 1)]), return_inverse=True)
    before, behind = at[: len(counts.pairs)], at[len(counts.pairs) :]
    times = np.bincount(behind, counts.n, len(codes))

    def of(chain: tuple[str, ...]) -> np.ndarray:
        made = [b"\n" if c == _END else garble(chr(c), chain).encode("utf-8", "replace") for c in codes.tolist()]
        data, size = np.frombuffer(b"".join(made), np.uint8).astype(np.intp), np.array([len(m) for m in made], np.intp)
        ends, owner = np.cumsum(size), np.repeat(np.arange(len(made)), size)
        within = np.flatnonzero(owner[:-1] == owner[1:])
        grams = np.bincount(data[within] << 8 | data[within + 1], times[owner[within]], 1 << 16)
        return grams + np.bincount(data[ends - 1][before] << 8 | data[ends - size][behind], counts.n, 1 << 16)

    rows = [of(())] + [counts.grams[JOINED.index(k)] if k in JOINED else of(c) for k, c in enumerate(CHAINS)]
    return np.stack([np.bincount(bucket, r, BUCKETS) for r in rows])


class ChainModel:
    """Log odds of every hashed byte bigram, for each chain against clean text."""

    def __init__(self, clean: Counts) -> None:
        smoothed = chain_counts(clean) + ALPHA
        log_p = np.log(smoothed / smoothed.sum(axis=1, keepdims=True))
        self.text = CleanText(clean.pairs, clean.n)
        self.odds = (log_p[1:] - log_p[0]).astype(np.float32)
        self.by_gram = np.ascontiguousarray(self.odds.T)
        self.most: dict[int, np.ndarray] = {}  # the best odds of each set of chains met
        self.known: dict[tuple, tuple | None] = {}  # the readings of short stretches met

    def stretch(self, text: str, best_of_all: bool = True) -> tuple[int, int, tuple[str, ...], str | None] | None:
        """Begin, end, chain and restored text (null where bytes are lost) of the garbled stretch
        whose restoration gains most, or of the first one found, the chain with most odds first."""
        return self.stretches([text], best_of_all)[0]

    def stretches(self, texts: list[str], best_of_all: bool) -> list[tuple[int, int, tuple[str, ...], str | None] | None]:
        """The same of each of some texts."""
        out, group, size = [None] * len(texts), [], 0
        rest = [n for n, t in enumerate(texts) if not t.isascii() and (len(t) > 3 or len(t.encode("utf-8", "replace")) > 3)]
        for i, n in enumerate(rest):
            group.append(n)
            size += len(texts[n])
            if size < TOGETHER and i + 1 < len(rest):
                continue
            alike: dict[int, list[int]] = {}
            for m, bits in zip(group, _chains([texts[m] for m in group]), strict=True):
                alike.setdefault(bits, []).append(m)
            alike.pop(0, None)
            for bits, members in alike.items():
                for m, groups in self._candidates([texts[m] for m in members], bits, best_of_all):
                    out[members[m]] = self._first_or_best(texts[members[m]], groups, best_of_all)
            group, size = [], 0
        return out

    def _first_or_best(self, text: str, groups: Iterable[list[tuple]], best_of_all: bool) -> tuple[int, int, tuple[str, ...], str | None] | None:
        best = None
        for found in groups:
            for _, begin, end, k in found:
                a, b = self._widened(text, begin, end)
                done = self._restored(text, a, b, CHAINS[k], best_of_all)
                if done is not None and (best is None or done[0] > best[0]):
                    best = done
                    if not best_of_all:
                        return best[1:]
        return best and best[1:]

    def _candidates(self, texts: list[str], bits: int, best_of_all: bool) -> Iterator[tuple[int, Iterator[list[tuple]]]]:
        """Of the texts that have any, their number and the stretches with enough odds for one of the chains:
        negative odds, begin, end, chain; the most odds first, of all chains in one list or in one for each chain."""
        data = np.frombuffer("\n".join(texts).encode("utf-8", "replace"), np.uint8)
        grams, char = _bigrams(data).astype(np.intp), np.cumsum((data & 0xC0) != 0x80) - 1
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])  # the texts' first characters
        breaks = char.searchsorted(first[1:-1]) - 1  # the line breaks between them
        # Behind each text all gains are at 0: no bigram has odds of over 32.
        fall = np.zeros(len(grams), bool)
        fall[breaks - 1] = fall[breaks] = True
        low = -32.0 * len(data)
        # No chain gains more anywhere than the best odds of these chains do, so only where these gain enough is anything to find.
        chains = [k for k in range(len(CHAINS)) if bits >> k & 1]
        if bits not in self.most:
            self.most[bits] = self.odds[chains].max(axis=0)
        odds = self.most[bits].take(grams)
        odds[fall] = low
        begins, ends = _risen(_gains(odds))
        if not len(begins):
            return
        # All gains are at 0 where the best one is, so the parts can be looked at beside one another.
        size = np.minimum(ends, len(grams)) - begins
        at = np.repeat(begins - np.cumsum(size) + size, size) + np.arange(size.sum())
        odds = self.by_gram.take(grams[at], axis=0).T[chains]
        odds[:, fall[at]] = low
        gains = _gains(odds).ravel()
        begins, ends = _risen(gains)  # each row begins at 0
        if not len(begins):
            return
        row, place = np.divmod(begins, len(at) + 1)
        owner = first.searchsorted(char[at[place]], "right") - 1
        tops = np.maximum.reduceat(gains, begins)  # what is between the parts is lower

        def stretch(n: int) -> tuple[float, int, int, int]:
            begin, k = int(begins[n]), int(row[n])
            last = int(at[begin + int(np.argmax(gains[begin : ends[n]])) - 1 - k * (len(at) + 1)]) + 1
            return -float(tops[n]), int(char[at[place[n]]] - first[owner[n]]), int(char[last] - first[owner[n]]) + 1, chains[k]

        of_text: dict[int, dict[int, list[int]]] = {}
        for n, (m, k) in enumerate(zip(owner.tolist(), row.tolist(), strict=True)):
            of_text.setdefault(m, {}).setdefault(0 if best_of_all else k, []).append(n)
        for m, lists in of_text.items():
            by_odds = sorted(lists.values(), key=lambda some: -max(tops[n] for n in some))
            yield m, (sorted(map(stretch, some)) for some in by_odds)

    def _widened(self, text: str, a: int, b: int) -> tuple[int, int]:
        """The stretch with the characters beside it that clean text doesn't have."""
        strange = lambda c: c > "\x7f" and not self.text.single[min(ord(c), 0xFFFF)]
        while a > 0 and strange(text[a - 1]):
            a -= 1
        while b < len(text) and strange(text[b]):
            b += 1
        return a, b

    def _restored(self, text: str, a: int, b: int, chain: tuple[str, ...], best_of_all: bool) -> tuple[float, int, int, tuple[str, ...], str | None] | None:
        """Gain, begin, end, chain and restored text of the best reading of a stretch, or of the first one, if it gains enough."""
        # A stretch begins with a character beyond ASCII, which stays what it is, and ends with one or with the one behind it.
        part = text[a:b].lstrip(_ASCII)
        a, b = b - len(part), min(b, b - len(part) + len(part.rstrip(_ASCII)) + 1)
        if a == b:
            return None
        if b - a > 2 * TRIM:
            return self._read(text, a, b, chain, best_of_all)
        # Short ones come again and again; beside the stretch only a character on either side matters.
        key = (text[a - 1] if a else "\n", text[a : b + 1], b - a, chain, best_of_all)
        if key not in self.known:
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[key] = self._read(key[0] + key[1], 1, 1 + b - a, chain, best_of_all)
        done = self.known[key]
        return done and (done[0], done[1] + a - 1, done[2] + a - 1, *done[3:])

    def _lines_log_p(self, lines: list[str]) -> float:
        """Log likelihood of lines, each by itself."""
        log_p = np.append(self.text.log_p("\n" + "\n".join(lines)), 0.0)
        return float(log_p.sum() - log_p[np.cumsum([len(t) + 1 for t in lines], dtype=np.intp) - 1].sum())

    def _stands(self, text: str, a: int, b: int) -> list[float]:
        """The running likelihood of a stretch as it stands, in its place; empty if that costs less than a restoration must gain."""
        sums = np.concatenate([[0.0], np.cumsum(self.text.log_p((text[a - 1] if a else "\n") + text[a : b + 1]))]).tolist()
        return sums if -sums[-1] >= GAIN and -sums[b - a] >= GAIN - LOST_GAIN else []

    def _read(self, text: str, a: int, b: int, chain: tuple[str, ...], best_of_all: bool) -> tuple[float, int, int, tuple[str, ...], str | None] | None:
        best, within = None, _encodable(text[a + TRIM - 1 : b - TRIM + 1], chain[-1])  # what is in every part
        long = b - a >= SHORT
        stands = self._stands(text, a, b) if within and not long else None
        for i in range(min(TRIM, b - a) if within and stands != [] else 0):
            if text[a + i] <= "\x7f":
                continue
            for j in range(min(TRIM, b - a - i)):
                x, y = a + i, b - j
                part, before, after = text[x:y], text[x - 1] if x else "\n", text[y : y + 1]
                if stands and stands[x - a] - stands[y + len(after) - a] < GAIN:
                    continue
                if (part[-1] <= "\x7f" and part[-2:-1] <= "\x7f") or _LOST in part or (back := invert(part, chain)) is None or back == part:
                    continue
                if long and len(back) == len(part) and self.text.gain(before + back + after, before + part + after) < GAIN - 0.001:
                    continue
                if stands is None:
                    stands = self._stands(text, a, b)
                if not stands or (cost := stands[x - a] - stands[y + len(after) - a]) < GAIN:
                    continue
                gain = float(self.text.log_p(before + back + after).sum() + cost)
                if gain >= GAIN and (best is None or gain > best[0]):
                    best = (gain, x, y, chain, back)
                    if not best_of_all:
                        return best
        part = text[a:b]
        if best is None and _LOST in part:
            # What is left between lost bytes, decoded as far as it goes.
            pieces = [(p, back, back.strip(_LOST + "?")) for p in part.split(_LOST) if not p.isascii() and (back := invert(p, chain, strict=False)) is not None]
            lost = sum(len(back) - len(whole) for _, back, whole in pieces)
            gain = LOST_GAIN + LOST_COST * lost + self._lines_log_p([whole for _, _, whole in pieces]) - self._lines_log_p([p for p, _, _ in pieces])
            if gain >= GAIN:
                best = (gain, a, b, chain, None)
        return best


_SOLE_LETTER = re.compile("(?<![^\x00-\x7f])[À-ÖØ-öø-ÿ](?![^\x00-\x7f])")


@cache
def _usual() -> re.Pattern:
    return re.compile(f"[\x00-\x7f{''.join(SEED)}]*")


def seeded(text: str) -> bool:
    """Whether a text is clean without a doubt: usual characters, and accented letters among ASCII ones."""
    return bool(_usual().fullmatch(text) or _usual().fullmatch(_SOLE_LETTER.sub("", text)))


def _scan(batches: Iterator[pd.DataFrame], model: ChainModel, restore: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, field, text, found in zip(batch.law_id, batch.field_name, batch.text, model.stretches(batch.text.tolist(), restore), strict=True):
            rest, chains, whole = text, [], True
            if found is None:
                continue
            while restore and found is not None and len(chains) < len(text):
                a, b, chain, back = found
                chains.append(">".join(chain))
                if back is None:
                    whole = False
                    break
                rest = rest[:a] + back + rest[b:]
                found = model.stretch(rest)
            rows.append((field, key, sorted(set(chains)), rest if whole else None))
        yield pd.DataFrame(rows, columns=["field_name", "law_id", "chains", "restored"])


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """law_id, field_name, text of every value that is looked at, each once."""
    law = table(spark, sf_dir, "law_detail").select(
        F.col("lawlist.law.secFutrsLawId").alias("law_id"),
        F.explode(F.array(
            F.struct(F.lit("law_name").alias("field_name"), F.col("lawlist.law.secFutrsLawName").alias("text")),
            F.struct(F.lit("body_after").alias("field_name"), F.col("lawlist.law.bodyAftCntnt").alias("text")),
        )).alias("x"),
    ).select("law_id", "x.*")
    full = table(spark, sf_dir, "law_document").select("law_id", F.lit("full_text").alias("field_name"), F.col("full_text").alias("text"))
    return law.unionAll(full).where(F.col("law_id").isNotNull() & (F.length(F.trim("text")) > 0))


def _sure(texts: list[str]) -> Iterator[tuple[str, int]]:
    return ((t, int(seeded(t))) for t in texts)


def _changes(texts: list[str], model: ChainModel) -> Iterator[tuple[str, int]]:
    """The texts, and by how much each counts more in the second model than in the first."""
    return ((t, (found is None) - seeded(t)) for t, found in zip(texts, model.stretches(texts, False), strict=True))


def fit(rows: DataFrame) -> ChainModel | None:
    """The model of all clean values; null if there are none without a doubt."""

    def counted(weigh: Callable[[list[str]], Iterable[tuple[str, int]]]) -> Counts:
        tallied = rows.select("text").mapInPandas(lambda it: _weighed(x for batch in it for x in weigh(batch.text.tolist())), "chain int, gram bigint, n bigint")
        sums = tallied.groupBy("chain", "gram").agg(F.sum("n").alias("n")).where("n <> 0").toArrow()
        return _counts(*(sums[c].to_numpy() for c in ("chain", "gram", "n")))

    sure = counted(_sure)
    if not len(sure.pairs):
        return None
    first = rows.sparkSession.sparkContext.broadcast(ChainModel(sure))
    model = ChainModel(sure + counted(lambda texts: _changes(texts, first.value)))
    first.destroy()
    return model


def fitted(texts: list[str]) -> ChainModel | None:
    """The same of texts in a list."""
    counted = lambda weighed: _counts(*pd.concat(_weighed(weighed)).to_numpy(np.int64).T)
    sure = counted(_sure(texts))
    if not len(sure.pairs):
        return None
    return ChainModel(sure + counted(_changes(texts, ChainModel(sure))))


def garbled(rows: DataFrame, restore: bool) -> DataFrame:
    """field_name, law_id, chains, restored (null where bytes are lost) of garbled values."""
    schema = "field_name string, law_id string, chains array<string>, restored string"
    model = fit(rows)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # chains times buckets, and the pairs of characters in use, whatever the number of rows
    return rows.mapInPandas(lambda it: _scan(it, shared.value, restore), schema)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field and law_id of every value that contains wrongly decoded text."""
    return garbled(values(spark, sf_dir), False).select("field_name", "law_id").distinct()


def p7_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same values with the chains that were inverted and the restored text."""
    return garbled(values(spark, sf_dir), True).select("field_name", "law_id", F.array_join("chains", "; ").alias("chains"), "restored").distinct()


QUERIES = {"p7_found": p7_found, "p7_restored": p7_restored}
