"""Benchmark decontamination: a BM25 index of test items searched by block-max WAND (operator 10).

An item's terms are its distinct five-word shingles (the whole sequence where it has fewer
words), lower-cased in ASCII; the index holds BM25 impacts in posting lists cut into blocks with
their maxima. Every training document is a query. An item is retrieved where its score
reaches the least that any ``OVERLAP`` share of its terms can reach, so nothing similar enough
is missed; then the overlap with the whole item, its question (before the last line break) and
its answer (after it) is counted exactly, and items below ``OVERLAP`` are dropped.

The index is sent to the tasks in parts of at most ``PART_WORDS`` item words, one pass over the
documents for each part, so what is broadcast never outgrows that bound.

Defined results: null and empty texts and items without words match nothing; items of equal text
match alike, each under its id; repeated document rows give one row per document and item;
empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.textnum import WORDS, chunks, lower_ascii, word_hashes, words

SHINGLE = 5
OVERLAP = (75, 100)
K1, B = 1.2, 0.75
BLOCK = 64
PART_WORDS = 2_000_000
_FILTER_BITS = 22


def terms(text: str | None) -> tuple[int, np.ndarray]:
    """(words in a term, distinct term hashes) of an item or a part of one."""
    data = lower_ascii(np.frombuffer((text or "").encode(), np.uint8))
    starts, ends, _ = words(data, np.array([0, len(data)]))
    n = min(SHINGLE, len(starts))
    if not n:
        return 0, np.zeros(0, np.uint64)
    return n, np.unique(WORDS.runs(WORDS.prefix(word_hashes(data, starts, ends)), n))


class Index:
    """Posting lists of the items' terms with block maxima; impacts are scaled so that every item's threshold is 1."""

    def __init__(self, items: list[tuple[int, str | None]]) -> None:
        parts = []
        for key, text in items:
            whole = text or ""
            question, _, answer = whole.rpartition("\n")
            parts.append((key, terms(whole), terms(question), terms(answer if question else "")))
        parts = [p for p in parts if len(p[1][1])]
        self.keys = [p[0] for p in parts]
        self.parts = [[h for _, h in p[1:]] for p in parts]
        self.lengths = sorted({n for p in parts for n, _ in p[1:] if n})
        self.vocabulary = np.unique(np.concatenate([h for p in self.parts for h in p] or [np.zeros(0, np.uint64)]))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.vocabulary >> np.uint64(64 - _FILTER_BITS)] = True
        number = np.concatenate([np.full(len(p[0]), i) for i, p in enumerate(self.parts)] or [np.zeros(0, int)])
        term = np.searchsorted(self.vocabulary, np.concatenate([p[0] for p in self.parts] or [np.zeros(0, np.uint64)]))
        df = np.bincount(term, minlength=len(self.vocabulary))
        idf = np.log1p((len(parts) - df + 0.5) / (df + 0.5))
        size = np.array([len(p[0]) for p in self.parts], float)
        norm = K1 * (1 - B + B * size / (size.mean() if len(size) else 1))
        impact = idf[term] * (K1 + 1) / (1 + norm[number])
        for i in range(len(parts)):  # the least score of a sufficient share of the item's terms
            own = number == i if len(parts) <= 64 else slice(*np.searchsorted(number, [i, i + 1]))
            least = np.sort(impact[own])[: math.ceil(size[i] * OVERLAP[0] / OVERLAP[1])].sum()
            impact[own] /= least
        order = np.lexsort((number, term))
        self.item, self.impact = number[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1))
        self.block_max = [np.maximum.reduceat(self.impact[s:e], np.arange(0, e - s, BLOCK)) if e > s else np.zeros(0) for s, e in zip(self.first[:-1], self.first[1:], strict=True)]
        self.top = np.array([m.max() if len(m) else 0.0 for m in self.block_max])

    def search(self, query: np.ndarray, threshold: float = 1 - 1e-9) -> list[int]:
        """Items whose score over the query's term numbers reaches the threshold: block-max WAND."""
        lists = [(int(self.first[t]), int(self.first[t + 1]), t) for t in query if self.first[t] < self.first[t + 1]]
        at = [s for s, _, _ in lists]
        found = []
        while True:
            live = sorted((int(self.item[at[j]]), j) for j, (_, e, _) in enumerate(lists) if at[j] < e)
            bound, pivot = 0.0, None
            for k, (_, j) in enumerate(live):
                bound += self.top[lists[j][2]]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot is None:
                return found
            item = live[pivot][0]
            while pivot + 1 < len(live) and live[pivot + 1][0] == item:
                pivot += 1
            ahead = live[: pivot + 1]
            blocks = 0.0  # the maxima of the blocks that would hold the pivot item
            skip = live[pivot + 1][0] if pivot + 1 < len(live) else len(self.keys)
            for _, j in ahead:
                s, e, t = lists[j]
                p = s + int(np.searchsorted(self.item[s:e], item))
                if p < e:
                    b = (p - s) // BLOCK
                    blocks += self.block_max[t][b]
                    skip = min(skip, int(self.item[min(s + (b + 1) * BLOCK, e) - 1]) + 1)
            if blocks >= threshold:
                score = 0.0
                for _, j in ahead:
                    s, e, _ = lists[j]
                    p = s + int(np.searchsorted(self.item[s:e], item))
                    if p < e and self.item[p] == item:
                        score += self.impact[p]
                        p += 1
                    at[j] = p
                if score >= threshold:
                    found.append(item)
            else:
                for _, j in ahead:
                    s, e, _ = lists[j]
                    at[j] = max(at[j], s + int(np.searchsorted(self.item[s:e], max(skip, item + 1))))

    def overlaps(self, item: int, have: np.ndarray) -> list[tuple[int, int]]:
        """(terms that a document has, terms) of the item, its question and its answer."""
        return [(int(np.isin(np.searchsorted(self.vocabulary, h), have).sum()), len(h)) for h in self.parts[item]]


_HITS = "item_id long, n_terms long, n_matched long, overlap double, question_overlap double, answer_overlap double"


def _share(have: int, n: int) -> float | None:
    return have / n if n else None


def _searcher(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(x.split()[0] for x in _HITS.split(", "))]
        for b in batches:
            rows = []
            for i, data, off in chunks(b.column(1)):
                data = lower_ascii(data)
                starts, ends, first = words(data, off)
                prefix = WORDS.prefix(word_hashes(data, starts, ends))
                terms_, texts = [], []
                for n in index.lengths:
                    h = WORDS.runs(prefix, n)
                    at = np.flatnonzero(index.filter[h >> np.uint64(64 - _FILTER_BITS)])
                    term = np.minimum(np.searchsorted(index.vocabulary, h[at]), len(index.vocabulary) - 1)
                    hit = index.vocabulary[term] == h[at]
                    at, term = at[hit], term[hit]
                    text = np.searchsorted(first, at, "right") - 1
                    one = at + n <= first[text + 1]  # within one document
                    terms_.append(term[one])
                    texts.append(text[one])
                if not terms_:
                    continue
                pairs = np.unique(np.stack([np.concatenate(texts), np.concatenate(terms_)], 1), axis=0)
                for group in np.split(pairs, np.flatnonzero(np.diff(pairs[:, 0])) + 1) if len(pairs) else []:
                    have = group[:, 1]
                    for item in index.search(have):
                        (m, n), *others = index.overlaps(item, have)
                        if OVERLAP[1] * m >= OVERLAP[0] * n:
                            rows.append((b.column(0)[i + int(group[0, 0])].as_py(), index.keys[item], n, m, m / n, *(_share(*o) for o in others)))
            kinds = [b.schema.types[0], pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    return run


def index_parts(items: DataFrame) -> Iterator[Index]:
    """Indexes of the items, each of about PART_WORDS words at most."""
    rows = items.select(F.col("item_id").cast("long"), "text").where(F.col("item_id").isNotNull())
    n = max(1, math.ceil((rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0) / PART_WORDS))
    for p in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == p)
        yield Index(sorted((r["item_id"], r["text"] or "") for r in part.collect()))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_terms, n_matched, overlap, question_overlap, answer_overlap) of every leak.

    The overlap of an empty question or answer is null.
    """
    rows = docs.select("doc_id", "text")
    kind = rows.schema[0].dataType.simpleString()
    found = [rows.mapInArrow(_searcher(index), f"doc_id {kind}, {_HITS}") for index in index_parts(items)]
    names = [x.split()[0] for x in _HITS.split(", ")]
    best = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(F.max(F.struct("n_matched", *(n for n in names if n not in ("item_id", "n_matched")))).alias("best"))
    return best.select("doc_id", "item_id", *(f"best.{n}" for n in names[1:]))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, columns unchanged."""
    leaked = contaminated(docs, items).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(*docs.columns)
