"""Problem 8: token ids of every document by a public byte-level BPE vocabulary.

Pieces of the published pre-tokenisation pattern are merged by a segment tree over their
byte positions. A leaf holds the rank of the pair that begins at its byte, the root the
leftmost minimum; a merge takes the root and updates the leaves of the merged pair and of
its live neighbours, each along one path to the root. Pieces of similar length go in step,
one row each, so a level of all their trees is one array operation. Where two bytes stand
beside one another in no token of the vocabulary, nothing merges across, so pieces are cut
there; equal pieces, and equal parts of them, are merged once and remembered.

Results in special cases: null and empty texts have the empty list; texts and pieces of
any length are encoded whole; equal texts under other ids are rows of their own; special
tokens are ordinary text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.session import table

#: Where the vocabulary lies; a parameter of the query.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published pre-tokenisation pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Cells (pieces times width) of the trees that go in step; bounds memory only.
CELLS = 1 << 17
#: Pieces, and parts of them, remembered between batches; a bound of memory, the others are merged again.
REMEMBERED = 150_000
#: Characters of the texts that are encoded at once; bounds memory only.
AT_ONCE = 1 << 20
_DEAD = np.int64(1) << 62


class PairRanks:
    """Rank of any two tokens that merge, for arrays of pairs: a hash table of open addressing."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        a = np.array(pairs, np.int64)
        self.size = 1 << (int(len(a) * 2.5).bit_length())
        self.key = np.full(self.size, -1, np.int64)
        self.rank = np.full(self.size, _DEAD, np.int64)
        keys, left = (a[:, 0] << 20) | a[:, 1], np.arange(len(a))
        slot = self._slot(keys)
        while len(left):
            free = self.key[slot[left]] < 0
            took = left[free]
            self.key[slot[took]] = keys[took]
            own = took[self.key[slot[took]] == keys[took]]
            self.rank[slot[own]] = a[own, 2]
            left = np.setdiff1d(left, own, assume_unique=True)
            slot[left] = (slot[left] + 1) & (self.size - 1)
        self.bytes = np.full(256, -1, np.int64)
        for t, r in ranks.items():
            if len(t) == 1:
                self.bytes[t[0]] = r

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.int64(-7046029254386353131)) >> np.int64(30)) & np.int64(self.size - 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 20) | b
        slot = self._slot(key)
        at = self.key[slot]
        out = np.where(at == key, self.rank[slot], _DEAD)
        open_ = np.flatnonzero((at != key) & (at >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (self.size - 1)
            at = self.key[slot[open_]]
            hit = at == key[open_]
            out[open_[hit]] = self.rank[slot[open_[hit]]]
            open_ = open_[~hit & (at >= 0)]
        return out


def merge_rows(pieces: list[bytes], pair_rank: PairRanks) -> list[list[int]]:
    """Token ids of some pieces, merged in step in segment trees of one width."""
    m = len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, m)
    w = 1 << max(1, int(lengths.max() - 1).bit_length())
    token = np.full((m, w + 1), -1, np.int64)
    filled = np.arange(w + 1) < lengths[:, None]
    token[filled] = pair_rank.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    token = token.ravel()
    stride = w + 1  # each row has a place behind its last byte, which never has a token
    after = np.tile(np.minimum(np.arange(1, stride + 1), w), (m, 1)).ravel()
    before = np.tile(np.maximum(np.arange(-1, w), 0), (m, 1)).ravel()
    # A leaf's key is its pair's rank and its position, so the least is also the leftmost.
    tree = np.full((m, 2 * w), _DEAD, np.int64)
    left, right = token.reshape(m, stride)[:, :w], token.reshape(m, stride)[:, 1:]
    both = right >= 0
    r = pair_rank(left[both], right[both])
    tree[:, w:][both] = np.where(r < _DEAD, r * w + np.broadcast_to(np.arange(w), (m, w))[both], _DEAD)
    level = w
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    tree = tree.ravel()
    rows = np.arange(m)
    while True:
        root = tree[rows * (2 * w) + 1]
        live = root < _DEAD
        if not live.all():
            rows, root = rows[live], root[live]
        if not len(rows):
            break
        base, top = rows * stride, rows * (2 * w)
        i = root & (w - 1)
        merged = root >> (w.bit_length() - 1)
        j = after[base + i]
        k = after[base + j]
        h = before[base + i]
        token[base + i] = merged
        token[base + j] = -1
        after[base + i] = k
        before[base + k] = i
        behind, ahead = token[base + k], token[base + h]
        new_i = pair_rank(merged, behind)
        new_i = np.where((behind >= 0) & (new_i < _DEAD), new_i * w + i, _DEAD)
        has = (i > 0) & (ahead >= 0)
        new_h = pair_rank(ahead, merged)
        new_h = np.where(has & (new_h < _DEAD), new_h * w + h, _DEAD)
        tree[top + w + j] = _DEAD
        tree[top + w + i] = new_i
        tree[(top + w + h)[has]] = new_h[has]
        # One path to the root per changed leaf, level by level; shared parts give the same value.
        node = np.concatenate([w + i, w + j, (w + h)[has]])
        at = np.concatenate([top, top, top[has]])
        while node[0] > 1:
            node = node >> 1
            child = at + 2 * node
            tree[at + node] = np.minimum(tree[child], tree[child + 1])
    token = token.reshape(m, stride)
    flat, counts = token[token >= 0].tolist(), (token >= 0).sum(axis=1)
    ends = np.cumsum(counts).tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class Lists:
    """Lists of ids, numbered, in one array."""

    def __init__(self) -> None:
        self.flat, self.begin, self.size = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of lists one behind the other, and how many each has."""
        size = self.size[numbers]
        return self.flat[np.repeat(self.begin[numbers] - np.cumsum(size) + size, size) + np.arange(size.sum())], size


class Encoder:
    """Encodes batches of texts and remembers pieces between them."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.pair_rank, self.find = PairRanks(ranks), regex.compile(PATTERN).findall
        self.known, self.ids = {}, Lists()
        self.known_parts, self.part_ids = {}, Lists()
        self.joined = np.zeros(1 << 16, bool)  # two bytes that stand beside one another in a token
        for t in ranks:
            for x, y in pairwise(t):
                self.joined[x << 8 | y] = True

    def _numbers(self, parts: list[bytes]) -> np.ndarray:
        """The numbers of parts, which are merged if they are new."""
        known = self.known_parts
        fresh = sorted({p for p in parts if p not in known}, key=len)
        at, flat, size = 0, [], []
        while at < len(fresh):
            w = 1 << max(1, (len(fresh[at]) - 1).bit_length())
            end = at
            most = max(1, CELLS // w)
            while end < len(fresh) and end - at < most and len(fresh[end]) <= w:
                end += 1
            for ids in merge_rows(fresh[at:end], self.pair_rank):
                flat += ids
                size.append(len(ids))
            at = end
        if fresh:
            known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
            self.part_ids.add(np.array(flat, np.int32), np.array(size, np.int64))
        return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))

    def merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one behind the other, and how many each has."""
        if len(self.known_parts) > REMEMBERED:
            self.known_parts, self.part_ids = {}, Lists()
        raw = "".join(pieces).encode("utf-8", "replace")
        data = np.frombuffer(raw, np.uint8)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        first = np.flatnonzero((data & 0xC0) != 0x80)[np.cumsum(length) - length]
        starts = np.ones(len(data), bool)
        starts[1:] = ~self.joined[data[:-1].astype(np.uint16) << 8 | data[1:]]
        starts[first] = True
        begin = np.flatnonzero(starts)
        size = np.diff(begin, append=len(data))
        number = np.empty(len(begin), np.int64)
        # Parts of up to eight bytes are compared as numbers, the few longer ones as bytes.
        for n in range(1, 9):
            if not len(where := np.flatnonzero(size == n)):
                continue
            cells = np.zeros((len(where), 8), np.uint8)
            for i in range(n):
                cells[:, i] = data[begin[where] + i]
            keys = cells.view("<u8").ravel()
            if n > 2:
                distinct, of = np.unique(keys, return_inverse=True)
            else:
                seen = np.bincount(keys.astype(np.int64), minlength=1 << 16) > 0
                distinct, of = np.flatnonzero(seen).astype("<u8"), (np.cumsum(seen) - 1)[keys]
            parts = distinct.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].tobytes()
            number[where] = self._numbers([parts[i : i + n] for i in range(0, len(parts), n)])[of]
        where = np.flatnonzero(size > 8)
        number[where] = self._numbers([raw[a : a + n] for a, n in zip(begin[where].tolist(), size[where].tolist(), strict=True)])
        flat, counts = self.part_ids.take(number)
        return flat, np.add.reduceat(counts, begin.searchsorted(first)) if len(pieces) else counts

    def arrays(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one behind the other, and where each text's begin and the last one's end."""
        split = [self.find(t) if t else [] for t in texts]
        fresh = {p for s in split for p in s if p not in self.known}
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, self.ids = {}, Lists()
            fresh = {p for s in split for p in s}
        pieces = list(fresh)
        self.ids.add(*self.merged(pieces))
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
        ends = np.cumsum([0, *map(len, split)])
        flat, size = self.ids.take(np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, ends[-1]))
        return flat, np.append(0, np.cumsum(size))[ends]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        flat, at = self.arrays(texts)
        return [ids.tolist() for ids in np.split(flat, at[1:-1])] if texts else []


#: The encoder of this worker, by the digest of its vocabulary.
_encoders: dict[str, Encoder] = {}


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and ids of each row of ``docs`` (doc_id, text). One pass, nothing is shuffled.

    The vocabulary, of fixed size, is read here and broadcast to the workers.
    """
    with open(vocabulary, "rb") as f:
        content = f.read()
    digest = hashlib.sha256(content).hexdigest()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if digest not in _encoders:
            _encoders.clear()
            _encoders[digest] = Encoder(shared.value)
        encoder = _encoders[digest]
        for batch in batches:
            doc_id, texts, begin, size = batch.column("doc_id"), batch.column("text").to_pylist(), 0, 0
            for end, text in enumerate(texts, 1):
                size += len(text or "")
                if size >= AT_ONCE or end == len(texts):
                    flat, at = encoder.arrays(texts[begin:end])
                    ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([doc_id.slice(begin, end - begin), ids], ["doc_id", "ids"])
                    begin, size = end, 0

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def p8_ids(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """The ids of each document's text by byte_bpe_50k, without special tokens."""
    return encode(table(spark, sf_dir, "documents"), vocabulary)


QUERIES = {"p8_ids": p8_ids}
