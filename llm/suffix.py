"""Suffix-array dedup with a difference cover (operator 6).

Texts are bytes. Phrases that share an anchor (see ``repeats``) meet in one block; a phrase whose
whole content occurs again is settled there. The others go, with their bytes, into suffix
arrays built block by block with the difference cover modulo 3: triples at the sampled
positions are sorted and named, the names' own suffix array gives the sampled ranks by
recursion, the remaining suffixes are ordered by their first byte and the rank behind it, and
both orders are merged. Neighbours in the array that agree on ``WIDTH`` bytes are repeats.

A block holds the phrases of whole anchors, ``BLOCK_BYTES`` at most unless one anchor has more;
an anchor with more than ``HOT`` different phrases does not enter a block: its windows are dealt
one by one by the hash of their whole content, exactly and without any group to gather.

Defined results: doc_id is a bigint; null and empty texts have no bytes and no spans; texts shorter than WIDTH lose
nothing; rows without an id neither lose bytes nor count as another place; a repeated row (same
id, same text) is another place, so both lose all they have from WIDTH bytes on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.repeats import ROW, _settled, byte_units, merged, send_phrases, send_windows, settle, stretches, with_stretches
from llm.textnum import chunks, ranges
from tablewatch.session import cut_lineage

WIDTH, GRAM = 400, 250
HOT = 128
BLOCK_BYTES = 1 << 19


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative integers by the difference cover {1, 2} modulo 3; fewer than 2**20 of them."""
    n = len(values)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: values[i:].tolist()), np.int64)
    _, t = np.unique(values, return_inverse=True)
    t = np.concatenate([t.astype(np.int64) + 1, np.zeros(4, np.int64)])
    # Sampled triples, sorted and named. For n = 1 modulo 3 one more sample keeps the two halves apart.
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triple = (t[sample] << 42) | (t[sample + 1] << 21) | t[sample + 2]
    distinct, name = np.unique(triple, return_inverse=True)
    if len(distinct) < len(sample):
        order = suffix_array(name)
        rank_of = np.empty(len(sample), np.int64)
        rank_of[order] = np.arange(len(sample))
    else:
        rank_of = name
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = rank_of + 1
    # The rest by (first value, rank of the suffix behind it); then both orders merge.
    zero = np.arange(0, n, 3)
    pair = lambda at: (t[at] << 21) | rank[at + 1]
    zero = zero[np.argsort(pair(zero), kind="stable")]
    one, two = one[one < n], two
    one, two = one[np.argsort(rank[one])], two[np.argsort(rank[two])]
    longer = lambda at: (t[at] << 42) | (t[at + 1] << 21) | rank[at + 2]
    before = np.searchsorted(pair(one), pair(zero)) + np.searchsorted(longer(two), longer(zero))
    out = np.empty(n, np.int64)
    place = before + np.arange(len(zero))
    taken = np.zeros(n, bool)
    taken[place] = True
    out[place] = zero
    both = np.concatenate([one, two])
    out[~taken] = both[np.argsort(rank[both])]
    return out


def repeated(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """For each text, which of its windows of ``width`` bytes also start elsewhere in these texts."""
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8)
    values = data.astype(np.int64) + len(texts)
    ends = np.cumsum(size + 1) - 1
    values[ends] = np.arange(len(texts))  # each end is a value of its own
    order = suffix_array(values)
    left = np.repeat(ends, size + 1) - np.arange(len(data))  # bytes to the end of the text
    order = order[left[order] >= width]
    a, b = order[:-1], order[1:]
    live = np.arange(len(a))  # neighbours whose prefixes agree so far
    word = np.zeros(len(data), np.uint64)
    for k in range(8):
        word[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(8 * k)
    for k in [*range(0, width - 7, 8), width - 8]:
        live = live[word[a[live] + k] == word[b[live] + k]] if width >= 8 else live
    if width < 8:
        for k in range(width):
            live = live[data[a[live] + k] == data[b[live] + k]]
    hit = np.zeros(len(data), bool)
    hit[a[live]] = hit[b[live]] = True
    start = np.concatenate([[0], ends + 1])
    return [hit[s : s + max(0, n - width + 1)] for s, n in zip(start, size, strict=False)]


_PHRASE = "anchor long, doc_id long, place int, many boolean, content binary"


def _contents(docs: DataFrame, which: DataFrame, width: int) -> DataFrame:
    """The bytes of phrases (doc_id, place, n, many, anchor)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(b.column(2).is_valid())
            ids = b.column(0).to_numpy()
            for i, data, off in chunks(b.column(1)):
                row, place, n, many = stretches(b.column(2), i, off, width)
                anchor = b.column(2).slice(i, len(off) - 1).flatten().field(3).to_numpy(zero_copy_only=False)
                raw = data.tobytes()
                content = [raw[s : s + m + width - 1] for s, m in zip((off[row] + place).tolist(), n.tolist(), strict=True)]
                yield pa.record_batch([pa.array(anchor), pa.array(ids[i + row]), pa.array(place.astype(np.int32)), pa.array(many), pa.array(content, pa.binary())], names=[x.split()[0] for x in _PHRASE.split(", ")])

    return with_stretches(docs, which).mapInArrow(run, _PHRASE)


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


def _blocks(width: int):
    """Suffix arrays over the sorted phrases of a partition, as many whole anchors at a time as fit."""

    def close(rows: list[tuple]) -> pa.RecordBatch:
        doc, place, n = [], [], []
        for (_, key, at, many, _), hit in zip(rows, repeated([r[4] for r in rows], width), strict=True):
            if not many:  # a phrase that occurs again is settled already
                s, m = _runs(hit)
                doc += [key] * len(s)
                place += (at + s).tolist()
                n += m.tolist()
        return _settled(np.array(doc, np.int64), np.array(place, np.int64), np.array(n, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        own: list[tuple] = []  # the anchor being read
        size = own_size = 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own and row[0] != own[0][0]:
                    if size + own_size > BLOCK_BYTES and block:
                        yield close(block)
                        block, size = [], 0
                    block, size, own, own_size = block + own, size + own_size, [], 0
                own.append(row)
                own_size += len(row[4]) + 1
        if size + own_size > BLOCK_BYTES and block:
            yield close(block)
            block = []
        if block or own:
            yield close(block + own)

    return run


def spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, place, n, many, anchor): stretches of n windows from byte ``place`` on that occur elsewhere."""
    found = cut_lineage(settle(send_phrases(docs, byte_units, width, gram, "anywhere"), "anywhere"))
    open_ = found.where("state = 2")
    crowd = open_.groupBy("anchor").agg(F.count("*").alias("kinds"))
    open_ = open_.join(crowd, "anchor").select("doc_id", "place", "n", "many", "anchor", (F.col("kinds") > HOT).alias("hot"))
    dealt = _contents(docs, open_.where("not hot"), width).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "place")
    one = dealt.mapInArrow(_blocks(width), ROW)
    two = settle(send_windows(docs, open_.where("hot"), byte_units, width, "anywhere"), "anywhere")
    names = ["doc_id", "place", "n", "many", "anchor"]
    return found.where("state = 1").select(*names).unionByName(one.select(*names)).unionByName(two.where("state = 1").select(*names))


_OUT = "n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, stop: long>>, kept binary"


def dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept): maximal removed runs of bytes, and the bytes that stay."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data, off in chunks(b.column(1)):
                row, place, n, _ = stretches(b.column(2), i, off, width)
                some = n > 0
                row, place, n = merged(row[some], place[some], n[some] + width - 1)
                keep = np.ones(len(data), bool)
                keep[ranges(off[row] + place, n)] = False
                size = len(off) - 1
                removed = np.bincount(row, n, size).astype(np.int64)
                cut = (off - np.concatenate([[0], np.cumsum(removed)])).tolist()
                raw = data[keep].tobytes()
                kept = [raw[s:e] for s, e in zip(cut[:-1], cut[1:], strict=True)]
                at = np.searchsorted(row, np.arange(size + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(place), pa.array(place + n)], names=["start", "stop"])).cast(span)
                yield pa.record_batch([b.column(0).slice(i, size), pa.array(np.diff(off)), pa.array(removed), pa.array(np.diff(at).astype(np.int64)), found, pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    rows = with_stretches(docs, spans(docs, width, gram))
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, {_OUT}")


def op6(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
