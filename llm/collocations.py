"""Phrase collocation mining by direct-address tiling (operator 13).

Words are counted first. The most frequent ones, ``Sizes.head`` at most, get ids by rank in their language, so the pairs
of head words fall into square tiles of ``TILE`` ids a side. In every task, tiles that hold many pairs are
counted by a dense bincount, cell by cell, and kept until the task ends; the pairs of all other
tiles, and those with a word behind the head (whose id is a hash), are counted as sorted
coordinates. Tasks send only their counts, which Spark adds up by pair, so no tile gathers in one task.
Pairs that reach the least count are ranked in the same way, and the most frequent ones, as units of
their own, make tiles with the word that follows them; this counts the three-word phrases.

What may be frequent is asked of Bloom filters of fixed size (words, then pairs): a phrase cannot be
more frequent than its parts. They only save rows; counts are exact. Hashes of words are checked to be
one to one over the vocabulary, with another seed if they are not.

All counts are per language; a null language is ``und``. Scores are exact (decimals). Defined results:
null and empty texts have no words; words are split at blanks and tabs, pieces at ``.,;:!?`` and U+000A
to U+000D, so phrases never cross them or the end of a text; repeated rows count again; no rows give
no phrases; doc_id is not read; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from llm import bloom
from llm.textnum import U64, Roller, chunks, lower_ascii, mix
from tablewatch.session import cut_lineage

LEAST, INSIDE, TOP = 10, 50, 2000
TILE = 1 << 10


@dataclass(frozen=True)
class Sizes:
    """Bounds of what is held in memory; none of them changes a count.

    head: words, and then pairs, that are addressed by rank; the driver and every task hold so many
    at most. dense: a tile is counted densely in a chunk from so many pairs on. tiles: a task holds so many
    dense tiles. word_bits, pair_bits: of the filters.
    """

    head: int = 1 << 16
    dense: int = 1 << 14
    tiles: int = 6
    word_bits: int = 1 << 23
    pair_bits: int = 1 << 25


SIZES = Sizes()
#: Ids of a group (language) lie in so many; a whole number of tiles.
GROUP = 1 << 20
#: Bytes of text whose phrases are counted together.
TOGETHER = (1 << 20) - 64

# Bytes that end a word, and those that end a piece as well.
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True

_TAIL = U64(1 << 63)


@lru_cache(2)
def _roller(seed: int) -> Roller:
    return Roller(1300 + seed)


def split(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text of each word, whether the next word is in the same piece)."""
    solid = ~(_GAP | _BREAK)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    text = np.searchsorted(off, starts, "right") - 1
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
    joined = np.zeros(len(starts), bool)
    if len(starts):
        joined[:-1] = (breaks[ends[:-1]] == breaks[starts[1:]]) & (text[:-1] == text[1:])
    return starts, ends, text, joined


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each word in its language, with the highest bit set."""
    r = _roller(seed)
    return mix(r.stretch(r.prefix(r.table[data]), starts, ends) ^ mix(lang.view(U64))) | _TAIL


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce("lang", F.lit("und"))
    return docs.select(lang.alias("lang"), F.xxhash64(lang).alias("code"), "text").where("text is not null")


def vocabulary(docs: DataFrame) -> tuple[DataFrame, int]:
    """((lang, word, h, n) of all words, seed of the hash h)."""

    def counted(seed: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                code = b.column(1).to_numpy()
                for i, data, off in chunks(b.column(2), TOGETHER):
                    data = lower_ascii(data)
                    starts, ends, text, _ = split(data, off)
                    h, first, n = np.unique(hashes(data, starts, ends, code[i + text], seed), return_index=True, return_counts=True)
                    raw = data.tobytes()
                    word = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
                    lang = b.column(0).take(pa.array(i + text[first]))
                    yield pa.record_batch([lang, pa.array(word, pa.binary()).cast(pa.string()), pa.array(h.view(np.int64)), pa.array(n)], names=["lang", "word", "h", "n"])

        return _texts(docs).mapInArrow(run, "lang string, word string, h long, n long").groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))

    for seed in range(4):
        found = cut_lineage(counted(seed))
        if found.groupBy("h").count().where("count > 1").isEmpty():
            return found, seed
    raise RuntimeError("words of the vocabulary have equal hashes under every seed")


class Ids:
    """Ids by rank for the most frequent units: ``id >> 10`` is a row of tiles, of one group alone."""

    def __init__(self, keys: np.ndarray, group: np.ndarray) -> None:
        """Fewer than GROUP keys by descending count, with the group (language) of each; ranks run within groups."""
        _, number = np.unique(group, return_inverse=True)
        order = np.argsort(number, kind="stable")
        begin = np.searchsorted(number[order], np.arange(number.max(initial=-1) + 1))
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys)) - begin[number[order]] if len(keys) else 0
        ids = (number.astype(np.int64) + 1) * GROUP + rank
        at = np.argsort(keys)
        self.keys, self.ids = keys[at], ids[at]
        by_id = np.argsort(self.ids)
        self.ordered, self.key_of = self.ids[by_id], self.keys[by_id]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ids, 0 for keys without one."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ids[at], 0)

    def back(self, ids: np.ndarray) -> np.ndarray:
        return self.key_of[np.searchsorted(self.ordered, ids)]


def most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """The rows with the largest n, ``size`` of them at most, all rows of a step of n (eight a power of two) or none.

    The driver learns how many rows each step has (a few hundred numbers), so no task or driver gathers and sorts more.
    """
    step = F.floor(F.log2("n") * 8)
    cut, taken = None, 0
    for k, c in sorted(((r[0], r[1]) for r in counts.groupBy(step).count().collect()), reverse=True):
        if taken + c > size:
            break
        cut, taken = k, taken + c
    return counts.where(step >= cut) if cut is not None else counts.limit(0)


def head(counts: DataFrame, key: str, group: str, size: int) -> Ids:
    """Ids of the most frequent rows (equal counts by key)."""
    top = most_frequent(counts, size).select(F.col(key).alias("k"), F.col(group).alias("g"), "n").toArrow()
    k, g, n = (top.column(c).to_numpy() for c in range(3))
    order = np.lexsort((k, -n))
    return Ids(k[order].view(U64), g[order])


class Tiles:
    """Counts of pairs of units: dense in the tiles that hold many, sorted coordinates elsewhere."""

    def __init__(self, left: Ids, right: Ids, sizes: Sizes) -> None:
        self.left, self.right, self.sizes = left, right, sizes
        self.dense: dict[tuple[int, int], np.ndarray] = {}

    def add(self, a: np.ndarray, b: np.ndarray, key_a: np.ndarray, key_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """ids (0: none) and keys of the pairs of a chunk; gives counts that are not kept."""
        rest = (a == 0) | (b == 0)
        both = np.flatnonzero(~rest)
        tile = (a[both] // TILE) << 32 | b[both] // TILE
        order = np.argsort(tile, kind="stable")
        name, begin, size = np.unique(tile[order], return_index=True, return_counts=True)
        for t, s, n in zip(name.tolist(), begin.tolist(), size.tolist(), strict=True):
            part = both[order[s : s + n]]
            known = (t >> 32, t & 0xFFFFFFFF) in self.dense
            if not known and (n < self.sizes.dense or len(self.dense) >= self.sizes.tiles):
                rest[part] = True
                continue
            cells = np.bincount((a[part] % TILE) * TILE + b[part] % TILE, minlength=TILE * TILE)
            if known:
                self.dense[t >> 32, t & 0xFFFFFFFF] += cells
            else:
                self.dense[t >> 32, t & 0xFFFFFFFF] = cells
        part = np.flatnonzero(rest)
        x, y = key_a[part], key_b[part]
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        first = np.flatnonzero(new)
        yield x[first], y[first], np.diff(np.append(first, len(x)))

    def close(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for (row, column), cells in self.dense.items():
            at = np.flatnonzero(cells)
            yield self.left.back(row * TILE + at // TILE), self.right.back(column * TILE + at % TILE), cells[at]
        self.dense = {}


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a + mix(b ^ U64(0x5851F42D4C957F2D)) * U64(3)) | _TAIL


def _keyed(h: np.ndarray, ids: Ids, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, whether each word may be frequent)."""
    found = ids.find(h)
    return found, (found > 0) | bloom.maybe(frequent, h)


def count_pairs(docs: DataFrame, seed: int, words: Ids, frequent: np.ndarray, sizes: Sizes) -> DataFrame:
    """(a, b, n): pairs of frequent words, by the words' hashes, and their occurrences in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles(words, words, sizes)
        rows = lambda a, b, n: pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(n)], names=["a", "b", "n"])
        for b in batches:
            code = b.column(1).to_numpy()
            for i, data, off in chunks(b.column(2), TOGETHER):
                data = lower_ascii(data)
                starts, ends, text, joined = split(data, off)
                h = hashes(data, starts, ends, code[i + text], seed)
                ids, ok = _keyed(h, words, frequent)
                at = np.flatnonzero(joined[:-1] & ok[:-1] & ok[1:])
                for found in tiles.add(ids[at], ids[at + 1], h[at], h[at + 1]):
                    yield rows(*found)
        for found in tiles.close():
            yield rows(*found)

    return _texts(docs).mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def count_triples(docs: DataFrame, seed: int, words: Ids, frequent: np.ndarray, pairs: Ids, both: tuple[np.ndarray, np.ndarray], frequent_pairs: np.ndarray, sizes: Sizes) -> DataFrame:
    """(a, b, c, n): triples of words whose two pairs are frequent, and their occurrences.

    ``both``: the words of the ranked pairs, sorted by the pairs' keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles(pairs, words, sizes)

        def rows(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([*(pa.array(x.view(np.int64)) for x in (a, b, c)), pa.array(n)], names=["a", "b", "c", "n"])

        for batch in batches:
            code = batch.column(1).to_numpy()
            for i, data, off in chunks(batch.column(2), TOGETHER):
                data = lower_ascii(data)
                starts, ends, text, joined = split(data, off)
                h = hashes(data, starts, ends, code[i + text], seed)
                ids, ok = _keyed(h, words, frequent)
                at = np.flatnonzero(joined[:-2] & joined[1:-1] & ok[:-2] & ok[1:-1] & ok[2:])
                a, b, c = h[at], h[at + 1], h[at + 2]
                key, later = pair_keys(a, b), pair_keys(b, c)
                may = bloom.maybe(frequent_pairs, key) & bloom.maybe(frequent_pairs, later)
                at, a, b, c, key = (x[may] for x in (at, a, b, c, key))
                ids_of = pairs.find(key)
                # A ranked pair is one only if its words are the same, not just the hash of both.
                if len(pairs.keys):
                    p = np.minimum(np.searchsorted(pairs.keys, key), len(pairs.keys) - 1)
                    ids_of[(both[0][p] != a) | (both[1][p] != b)] = 0
                place = np.arange(len(at)).astype(U64)  # rows that are not tiled come back by their place
                word = ids[at + 2]
                tiled = np.flatnonzero((ids_of > 0) & (word > 0))
                loose = np.ones(len(at), bool)
                loose[tiled] = False
                for x, y, n in tiles.add(ids_of[tiled], word[tiled], key[tiled], c[tiled]):
                    q = np.searchsorted(pairs.keys, x)
                    yield rows(both[0][q], both[1][q], y, n)
                left = place[loose].astype(np.int64)
                order = left[np.lexsort((c[left], b[left], a[left]))]
                x, y, z = a[order], b[order], c[order]
                new = np.ones(len(x), bool)
                new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])
                first = np.flatnonzero(new)
                yield rows(x[first], y[first], z[first], np.diff(np.append(first, len(x))))
        for x, y, n in tiles.close():
            q = np.searchsorted(pairs.keys, x)
            yield rows(both[0][q], both[1][q], y, n)

    return _texts(docs).mapInArrow(run, "a long, b long, c long, n long").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exactly."""
    big = lambda c: c.cast("decimal(20,0)")
    top = (big(a) * big(a)).cast("decimal(32,0)") * F.lit(1000000).cast("decimal(7,0)")
    return F.call_function("div", top, big(l) * big(r))


def phrases(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, sizes: Sizes = SIZES) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, a, l, r, score) of all phrases that are not part of a longer one, (lang, n) words)."""
    every, seed = vocabulary(docs)
    total = every.groupBy("lang").agg(F.sum("n").alias("n"))
    often = every.where(F.col("n") >= least)
    words = head(often.withColumn("group", F.xxhash64("lang")), "h", "group", sizes.head)
    frequent = bloom.build(often, "h", sizes.word_bits)
    pairs = cut_lineage(count_pairs(docs, seed, words, frequent, sizes).where(F.col("n") >= least))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = (b.column(k).to_numpy().view(U64) for k in (0, 1))
            yield pa.record_batch([*b.columns, pa.array(pair_keys(a, c).view(np.int64))], names=["a", "b", "n", "key"])

    keyed = pairs.mapInArrow(key, "a long, b long, n long, key long")
    frequent_pairs = bloom.build(keyed, "key", sizes.pair_bits)
    top = most_frequent(keyed, sizes.head).toArrow()
    order = np.lexsort((top.column("b").to_numpy(), top.column("a").to_numpy(), -top.column("n").to_numpy()))
    a, b, k = (top.column(c).to_numpy()[order].view(U64) for c in ("a", "b", "key"))
    _, single = np.unique(k, return_index=True)  # of pairs with one key the most frequent is ranked, the others are counted as coordinates
    single = np.sort(single)
    a, b, k = a[single], b[single], k[single]
    order = np.argsort(k)
    ranked = Ids(k, np.zeros(len(k), np.int64))
    triples = cut_lineage(count_triples(docs, seed, words, frequent, ranked, (a[order], b[order]), frequent_pairs, sizes).where(F.col("n") >= least))

    word = lambda p: often.select(F.col("h").alias(p), F.col("word").alias(f"word_{p}"), F.col("n").alias(f"n_{p}"))
    # Pairs inside a triple, with the count of the most frequent one.
    covered = triples.select(F.inline(F.array(F.struct("a", "b", "n"), F.struct(F.col("b").alias("a"), F.col("c").alias("b"), "n")))).groupBy("a", "b").agg(F.max("n").alias("longer"))
    two = pairs.join(covered, ["a", "b"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("n"))).drop("longer")
    two = two.join(word("a").join(often.select(F.col("h").alias("a"), "lang"), "a"), "a").join(word("b"), "b")
    two = two.select("lang", F.concat_ws(" ", "word_a", "word_b").alias("phrase"), F.col("n").alias("a"), F.col("n_a").alias("l"), F.col("n_b").alias("r"))
    two = two.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    three = triples.join(pairs.select("a", "b", F.col("n").alias("n_ab")), ["a", "b"]).join(pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("n_bc")), ["b", "c"])
    three = three.join(often.select(F.col("h").alias("a"), "lang", F.col("word").alias("word_a"), F.col("n").alias("n_a")), "a")
    three = three.join(word("b").drop("n_b"), "b").join(word("c"), "c")
    one, other = _score(F.col("n"), F.col("n_a"), F.col("n_bc")), _score(F.col("n"), F.col("n_ab"), F.col("n_c"))
    three = three.withColumn("one", one).withColumn("other", other).withColumn("early", F.col("one") <= F.col("other"))
    pick = lambda x, y: F.when(F.col("early"), F.col(x)).otherwise(F.col(y))
    three = three.select("lang", F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"), F.col("n").alias("a"), pick("n_a", "n_ab").alias("l"), pick("n_bc", "n_c").alias("r"), pick("one", "other").alias("score"))
    return two.unionByName(three), total


def best(found: DataFrame, total: DataFrame, top: int = TOP) -> DataFrame:
    """The first phrases of each language; each task cuts its own rows to as many before the shuffle."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13(docs: DataFrame) -> DataFrame:
    return best(*phrases(docs))
