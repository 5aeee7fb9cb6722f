"""SimHash fingerprints (operator 5).

Terms are runs of two and three words (single words where a text has no more), lower-cased in
ASCII; each occurrence votes on the 64 signed bits of its hash with its term's weight. Equal
texts have equal fingerprints; texts without words have the fingerprint 0.

``within_radius`` finds all fingerprints within a Hamming radius by permuted block tables.

Null texts count as empty; repeated rows each get a row; rows with the same id are ordered by
text when "the next document" is asked for; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.textnum import WORDS, chunks, inside, lower_ascii, word_hashes, words
from tablewatch.session import cut_lineage

BITS = 64
#: (words in a term, weight of each occurrence)
TERMS = ((2, 1), (3, 2))
BLOCKS = 6


def _votes(first: np.ndarray, hashes: np.ndarray, text_of: np.ndarray, weight: int, total: np.ndarray) -> None:
    """Add the signed votes of terms (in text order) to total (texts x 64)."""
    step = 1 << 16
    for i in range(0, len(hashes), step):
        h, t = hashes[i : i + step], text_of[i : i + step]
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
        head = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        ones = np.add.reduceat(bits, head, axis=0)
        n = np.diff(np.r_[head, len(t)])
        total[t[head]] += weight * (2 * ones - n[:, None])


def fingerprints(texts: pa.Array) -> np.ndarray:
    """64-bit fingerprint of every text."""
    out = np.zeros(len(texts), np.uint64)
    for i, data, off in chunks(texts):
        data = lower_ascii(data)
        starts, ends, first = words(data, off)
        w = word_hashes(data, starts, ends)
        counts = np.diff(first)
        text = np.repeat(np.arange(len(counts)), counts)
        prefix = WORDS.prefix(w)
        total = np.zeros((len(counts), BITS), np.int64)
        single = counts[text] == 1
        _votes(first, WORDS.runs(prefix, 1)[single], text[single], 1, total)
        for n, weight in TERMS:
            ok = inside(first, len(w), n)
            _votes(first, WORDS.runs(prefix, n)[ok], text[: len(ok)][ok], weight, total)
        bits = np.packbits(total > 0, axis=1, bitorder="little")
        out[i : i + len(counts)] = bits.view("<u8").ravel()
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the share of differing bits."""
    return 1 - np.bitwise_count(a ^ b) / BITS


def to_hex(fp: np.ndarray) -> list[str]:
    return [f"{x:016x}" for x in fp.tolist()]


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by the beginning of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprint(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint as a long) of every row."""
    rows = docs.select(F.col(key), F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(fingerprints(b.column(1)).view(np.int64))], names=[key, "fingerprint"])

    return rows.mapInArrow(run, f"{key} {rows.schema[0].dataType.simpleString()}, fingerprint long")


def within_radius(fps: DataFrame, queries: DataFrame, radius: int = 3, key: str = "doc_id") -> DataFrame:
    """All (query_fp, near_fp, distance) of different values with distance <= radius, exactly.

    The 64 bits are cut into ``radius + 3`` blocks; fingerprints within the radius agree on at
    least three blocks, so a table keyed by each choice of three holds every such pair.
    Equal fingerprints are one value; members are those rows of ``fps`` that carry it, so a
    group of copies is never spread into pairs. Null fingerprints match nothing.
    """
    n = radius + 3
    cuts = [round(i * BITS / n) for i in range(n + 1)]

    def keyed(values: DataFrame, name: str) -> DataFrame:
        fp = F.col(name)
        block = [F.shiftrightunsigned(fp, cuts[i]).bitwiseAND(F.lit((1 << cuts[i + 1] - cuts[i]) - 1)) for i in range(n)]
        tables = [F.struct(F.lit(t).alias("t"), *(block[i].alias(f"b{j}") for j, i in enumerate(c))) for t, c in enumerate(combinations(range(n), 3))]
        return values.select(fp, F.explode(F.array(*tables)).alias("k"))

    distinct = lambda df, name: df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
    left, right = keyed(distinct(queries, "query_fp"), "query_fp"), keyed(distinct(fps, "near_fp"), "near_fp")
    distance = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("near_fp")))
    near = left.join(right, "k").where((F.col("query_fp") != F.col("near_fp")) & (distance <= radius))
    return near.select("query_fp", "near_fp", distance.alias("distance")).distinct()


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, head string, tail string"


def _rows(ids: list, texts: list[str], fp: np.ndarray) -> pa.RecordBatch:
    """Results of all texts but the last; fp holds one fingerprint for each text."""
    changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    efp = fingerprints(pa.array(changed, pa.large_string()))
    none = pa.nulls(len(changed), pa.string())
    return pa.record_batch(
        [pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()), pa.array(to_hex(fp[:-1]), pa.string()), pa.array(to_hex(efp), pa.string()), pa.array(likeness(fp[:-1], efp), pa.float64()), pa.array(likeness(fp[:-1], fp[1:]), pa.float64()), none, none],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "head", "tail"],
    )


def _edge(head: tuple | None, tail: tuple | None) -> pa.RecordBatch:
    row = {"doc_id": (tail or head)[0], "head": head and head[1], "tail": tail and tail[1]}
    names = [x.split()[0] for x in _RESULT.split(", ")]
    kinds = {"doc_id": pa.int64(), "n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}
    return pa.record_batch([pa.array([row.get(n)], kinds.get(n, pa.string())) for n in names], names=names)


def _sorted_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition; its first text comes out as a head, its last as a tail without result."""
    ids: list = []
    texts: list[str] = []
    fp = np.zeros(0, np.uint64)
    for b in batches:
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            if not part.num_rows:
                continue
            new = [t or "" for t in part.column(1).to_pylist()]
            if not texts:
                yield _edge((part.column(0)[0].as_py(), new[0]), None)
            ids, texts = ids[-1:] + part.column(0).to_pylist(), texts[-1:] + new
            fp = np.concatenate([fp[-1:], fingerprints(part.column(1))])
            yield _rows(ids, texts, fp)
    if texts:
        yield _edge(None, (ids[-1], texts[-1]))


def op5(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, its edited text, and the next document's.

    Documents are range-partitioned and sorted by id, so the next one is the next row; only the
    first and last text of each partition (two rows a partition) meet in a second step.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    done = cut_lineage(rows.mapInArrow(_sorted_run, _RESULT))
    edges = done.where(F.col("head").isNotNull() | F.col("tail").isNotNull())
    order = [F.col("doc_id").asc_nulls_first(), F.col("tail").isNotNull(), F.coalesce("head", "tail")]
    by_id = Window.orderBy(*order)
    every = by_id.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = edges.withColumn("following", F.coalesce(F.lead("head").over(by_id), F.first("head", True).over(every)))
    pairs = met.where(F.col("tail").isNotNull()).select("doc_id", "tail", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, tail, following in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield _rows([key, None], [tail, following], fingerprints(pa.array([tail, following], pa.large_string())))

    last = pairs.mapInArrow(close, _RESULT)
    return done.where(F.col("fingerprint").isNotNull()).unionByName(last).drop("head", "tail")
