"""Substring dedup by relative Lempel-Ziv parsing (operator 1).

The reference of a document is all documents of smaller id, cut into phrases and indexed in
blocks (see ``repeats``). A document is parsed against every block: each of its phrases that the
reference holds is a factor, found whole by one lookup; where the reference holds the anchor in
another context, the phrase lies on a factor boundary and its windows are looked up one by
one. Adjoining factors are joined greedily, and the stretches of at least ``WIDTH`` words that
they cover are the duplicate spans.

Defined results: doc_id is a bigint; null and empty texts have no words; texts of fewer than WIDTH words lose
nothing; rows without an id neither lose words nor serve as reference; rows of one id are one
document (a repeated row is no earlier document; if their texts differ, places found in any of
them count for all). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.repeats import merged, send_phrases, send_windows, settle, stretches, with_stretches, word_units
from llm.textnum import chunks, words
from tablewatch.session import cut_lineage

WIDTH, GRAM = 13, 5


def factors(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, place, n, many, anchor): stretches of n windows from word ``place`` on that the reference holds."""
    found = cut_lineage(settle(send_phrases(docs, word_units, width, gram, "earlier"), "earlier"))
    edges = settle(send_windows(docs, found.where("state = 2"), word_units, width, "earlier"), "earlier")
    return found.where("state = 1").unionByName(edges.where("state = 1")).select("doc_id", "place", "n", "many", "anchor")


_OUT = "n_words long, n_removed long, spans array<struct<start: long, stop: long>>, kept string"


def parse(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): duplicate spans in words, and the other words joined by blanks."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data, off in chunks(b.column(1)):
                starts, ends, first = words(data, off)
                row, place, n, _ = stretches(b.column(2), i, first, width)
                some = n > 0
                row, place, n = merged(row[some], place[some], n[some] + width - 1)  # windows to words
                gone = np.zeros(len(starts) + 1, np.int64)
                np.add.at(gone, first[row] + place, 1)
                np.add.at(gone, first[row] + place + n, -1)
                keep = np.cumsum(gone)[:-1] == 0
                size = len(first) - 1
                removed = np.concatenate([[0], np.cumsum(~keep)])[first]
                raw, cut = data.tobytes(), np.searchsorted(np.flatnonzero(keep), first)
                s, e = starts[keep].tolist(), ends[keep].tolist()
                kept = [b" ".join([raw[x:y] for x, y in zip(s[lo:hi], e[lo:hi], strict=True)]) for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                at = np.searchsorted(row, np.arange(size + 1)).astype(np.int32)
                spans = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(place), pa.array(place + n)], names=["start", "stop"])).cast(span)
                yield pa.record_batch([b.column(0).slice(i, size), pa.array(np.diff(first)), pa.array(np.diff(removed)), spans, pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", *(x.split()[0] for x in ("n_words", "n_removed", "spans", "kept"))])

    rows = with_stretches(docs, factors(docs, width, gram))
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, {_OUT}")


def op1(docs: DataFrame) -> DataFrame:
    return parse(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
