"""Byte-level BPE encoding and decoding (operator 8).

Texts are split as the public pattern says, distinct pieces are encoded once per chunk, and
their ids are gathered back in text order. The merges run on length-bucketed padded matrices:
one row per distinct piece; every round looks all adjacent pairs up in a hash table, each row
merges its leftmost pair of least rank, and rows without a pair leave the matrix.

Null and empty texts give zero ids and empty decoded bytes; repeated rows give repeated
results; extra input columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.textnum import BYTES, chunks, ranges

#: Pieces longer than this merge through a heap instead of the matrices (same merges).
LONG = 256

NO_RANK = np.int64(1) << 40
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0

# The Unicode White_Space code points and the contraction endings of the pattern.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    kind = np.zeros(sys.maxunicode + 1, np.uint8)
    import regex

    every = "".join(chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)
    for name, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            lo, hi = ord(m[0][0]), ord(m[0][-1])
            if hi - lo + 1 == len(m[0]):
                kind[lo : hi + 1] = name
            else:  # the run spans the gap of the surrogates
                kind[[ord(c) for c in m[0]]] = name
    kind[WHITE_SPACE] = SPACE
    return kind


class Ranks:
    """A rank file: byte strings by id, and ids of joinable pairs in an open-addressing table."""

    def __init__(self, path: str) -> None:
        rank = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, n = line.split()
                    rank[base64.b64decode(token)] = int(n)
        self.size = max(rank.values()) + 1
        self.rank = rank
        self.single = np.array([rank[bytes([b])] for b in range(256)], np.int64)
        by_id = [b""] * self.size
        for t, n in rank.items():
            by_id[n] = t
        self.length = np.array([len(t) for t in by_id], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        pairs = [(a, b, n) for t, n in rank.items() for i in range(1, len(t)) if (a := rank.get(t[:i])) is not None and (b := rank.get(t[i:])) is not None]
        left, right, joined = (np.array(c, np.int64) for c in zip(*pairs, strict=True))
        self.bits = max(8, int(len(pairs) * 2).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.joined = np.full(1 << self.bits, NO_RANK, np.int64)
        key = left * self.size + right
        slot = self._slot(key)
        while len(key):  # insert all that find a free slot, move the others on by one
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[free]
            placed = self.keys[slot] == key
            self.joined[slot[placed]] = joined[placed]
            key, joined, slot = key[~placed], joined[~placed], (slot[~placed] + 1) & (1 << self.bits) - 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, NO_RANK where it is none; negative ids are padding."""
        key = left * self.size + right
        out = np.full(key.shape, NO_RANK, np.int64)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = key.ravel()[todo]
        slot = self._slot(key)
        flat = out.ravel()
        while len(todo):
            there = self.keys[slot]
            hit = there == key
            flat[todo[hit]] = self.joined[slot[hit]]
            on = ~hit & (there >= 0)
            todo, key, slot = todo[on], key[on], (slot[on] + 1) & (1 << self.bits) - 1
        return out

    def merge_matrix(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids: rows padded with -1 at the right. (merged rows, lengths)."""
        out, live = ids, np.arange(len(ids))
        now = ids
        while len(live) and now.shape[1] > 1:
            ranks = self.lookup(now[:, :-1], now[:, 1:])
            at = ranks.argmin(1)  # the first of the least
            best = ranks[np.arange(len(now)), at]
            joins = best < NO_RANK
            out[live[~joins], : now.shape[1]] = now[~joins]
            live, now, at, best = live[joins], now[joins], at[joins], best[joins]
            if not len(live):
                break
            cols = np.arange(now.shape[1] - 1)
            kept = np.take_along_axis(now, cols + (cols > at[:, None]), 1)  # compaction: all after the pair move left
            kept[np.arange(len(kept)), at] = best
            out[live, now.shape[1] - 1] = -1
            now = kept
        out[live, : now.shape[1]] = now
        return out, (out >= 0).sum(1)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of (rank, place) over a linked list."""
        ids = [int(self.single[b]) for b in piece]
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        width = [1] * n

        def rank(i: int) -> int | None:
            j = after[i]
            return self.rank.get(piece[i : i + width[i] + width[j]]) if j < n else None

        heap = [(r, i) for i in range(n) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or rank(i) != r:
                continue
            j = after[i]
            ids[i], width[i], alive[j], after[i] = r, width[i] + width[j], False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k))
        return np.array([ids[i] for i in range(n) if alive[i]], np.int64)

    def encode_pieces(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every piece, one piece after another, and how many each has."""
        found: list[np.ndarray] = [np.zeros(0, np.int64)]
        which: list[np.ndarray] = [np.zeros(0, np.int64)]
        counts = np.zeros(len(start), np.int64)
        lo = 0
        width = 4
        while lo < LONG:  # buckets of lengths 1-4, 5-8, 9-16, ...
            rows = np.flatnonzero((length > lo) & (length <= width))
            step = max(1, (1 << 20) // width)
            for part in (rows[i : i + step] for i in range(0, len(rows), step)):
                cols = np.arange(width)
                real = cols < length[part, None]
                ids = np.where(real, self.single[data[np.where(real, start[part, None] + cols, 0)]], -1)
                merged, n = self.merge_matrix(ids)
                counts[part] = n
                found.append(merged[merged >= 0])
                which.append(np.repeat(part, n))
            lo, width = width, width * 2
        for i in np.flatnonzero(length > LONG):
            ids = self.merge_long(data[start[i] : start[i] + length[i]].tobytes())
            counts[i] = len(ids)
            found.append(ids)
            which.append(np.full(len(ids), i))
        order = np.argsort(np.concatenate(which), kind="stable")
        return np.concatenate(found)[order], counts


@lru_cache(2)
def load_ranks(path: str) -> Ranks:
    return Ranks(path)


def pieces(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of the pattern's matches in texts laid end to end, and the first match of each text."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    at = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])
    kind = char_classes()[points]
    head = np.zeros(n + 1, bool)
    head[np.searchsorted(at, off)] = True  # a text begins
    head[n] = True
    space = kind == SPACE
    run = head[:-1].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    # The last white space before a solid character stands apart: it joins it if it is a blank.
    last = space.copy()
    last[:-1] &= ~space[1:] & ~head[1:-1]
    last[-1] = False
    start |= last
    joins = last & (points == 0x20)
    follow = np.flatnonzero(joins) + 1
    start[follow] = False
    # Contractions: an apostrophe where a match begins, then one of the fixed endings.
    quote = np.flatnonzero((points == 0x27) & start)
    if len(quote):
        quote = quote[np.concatenate([quote[1:] != quote[:-1] + 1, [True]])]
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        ends = np.concatenate([head, np.ones(3, bool)])
        done = np.zeros(len(quote), bool)
        for ending in CONTRACTIONS:
            ok = ~done
            for j, c in enumerate(ending, 1):
                ok &= (padded[quote + j] == ord(c)) & ~ends[quote + j]
            hit = quote[ok]
            done |= ok
            start[hit + 1] = False
            rest = hit + 1 + len(ending)
            rest = rest[rest < n]
            start[rest[(kind[rest] == LETTER)]] = True
    first = np.flatnonzero(start)
    return at[first], np.searchsorted(at[first], off)


def encode_chunk(ranks: Ranks, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts laid end to end, and where each text's ids begin (n + 1)."""
    start, first = pieces(data, off)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    end = np.append(start[1:], len(data))
    h = BYTES.stretch(BYTES.prefix(BYTES.table[data]), start, end)
    _, example, back = np.unique(h, return_index=True, return_inverse=True)
    ids, counts = ranks.encode_pieces(data, start[example], (end - start)[example])
    place = np.concatenate([[0], np.cumsum(counts)])
    n = counts[back]
    return ids[ranges(place[back], n)], np.concatenate([[0], np.cumsum(n)])[first]


def _local(path: str) -> str:
    return SparkFiles.get(path[6:]) if path.startswith("files:") else path


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids): ids as little-endian unsigned 32-bit integers in one binary per text.

    ``path`` is a rank file that every executor can open, or ``files:NAME`` for one sent with
    ``addFile``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(_local(path))
        for b in batches:
            keys = b.column(0)
            for i, data, off in chunks(b.column(1)):
                ids, first = encode_chunk(ranks, data, off)
                flat = ids.astype("<u4").tobytes()
                values = [flat[4 * s : 4 * e] for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.record_batch([keys.slice(i, len(values)), pa.array(values, pa.binary())], names=[key, "ids"])

    rows = docs.select(F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"{key} {rows.schema[0].dataType.simpleString()}, ids binary")


def decode_ids(ranks: Ranks, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The bytes that the ids stand for, row by row; first: where each row's ids begin (n + 1)."""
    n = ranks.length[ids]
    flat = ranks.flat[ranges(ranks.start[ids], n)].tobytes()
    cut = np.concatenate([[0], np.cumsum(n)])[first].tolist()
    return [flat[s:e] for s, e in zip(cut[:-1], cut[1:], strict=True)]


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the bytes that the ids stand for; a null is an empty row of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(_local(path))
        for b in batches:
            for i, data, off in chunks(b.column(1)):
                ids = data.view("<u4").astype(np.int64) if len(data) % 4 == 0 and data.flags.aligned else np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
                values = decode_ids(ranks, ids, off // 4)
                yield pa.record_batch([b.column(0).slice(i, len(values)), b.column(1).slice(i, len(values)), pa.array(values, pa.binary())], names=[key, "ids", "decoded"])

    rows = encoded.select(key, "ids")
    return rows.mapInArrow(run, f"{key} {rows.schema[0].dataType.simpleString()}, ids binary, decoded binary")


def round_trip(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): ``decode(encode(docs))`` in one pass, so a task keeps one worker and one set of tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(_local(path))
        for b in batches:
            for i, data, off in chunks(b.column(1)):
                ids, first = encode_chunk(ranks, data, off)
                flat = ids.astype("<u4").tobytes()
                values = [flat[4 * s : 4 * e] for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.record_batch([b.column(0).slice(i, len(values)), pa.array(values, pa.binary()), pa.array(decode_ids(ranks, ids, first), pa.binary())], names=[key, "ids", "decoded"])

    rows = docs.select(F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"{key} {rows.schema[0].dataType.simpleString()}, ids binary, decoded binary")


def op8(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again from the ids."""
    both = round_trip(docs, path)
    ids = F.coalesce("ids", F.lit(b""))
    return both.select("doc_id", (F.length(ids) / 4).cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2(F.coalesce("decoded", F.lit(b"")), 256).alias("decoded_sha256"))
