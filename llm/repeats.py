"""Finding repeated windows of units (words or bytes) without shuffling every window.

Every window of ``width`` units has an anchor: of the runs of ``gram`` units inside it, the
leftmost one of least hash. Equal windows have equal anchors at equal places, so the windows of
a text fall into *phrases*, stretches of consecutive windows with one anchor, and only phrases
travel: (hash of the anchor, hash of the phrase's whole content, document, place). Documents are
dealt by anchor; what reads the sorted rows of one partition has indexed a block of all texts,
and every document meets every block through its phrases.

A phrase that occurs again settles all its windows at once. Only where different phrases share
an anchor must windows be compared one by one, at the ends of repeated stretches; ``settle`` and
its callers do so in a second step.

``rule`` is "earlier" (a window counts where it also starts in a document of smaller id) or
"anywhere" (where it also starts at any other place). Repeats within a batch are settled before
the shuffle, so a group of copies sends one row per phrase and batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.textnum import BYTES, U64, WORDS, chunks, inside, ranges, sliding_min, word_hashes, words

#: anchor, content: hashes; doc_id; place: first window; n: windows; many: the content occurs
#: again; state: 0 open, 1 settled (repeats), 2 to be compared window by window.
ROW = "anchor long, content long, doc_id long, place int, n int, many boolean, state int"
#: Bytes of text whose repeats are settled together before the shuffle.
TOGETHER = 2 << 20
_NAMES = [x.split()[0] for x in ROW.split(", ")]

Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def byte_units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTES.table[data], off


def word_units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(data, off)
    return word_hashes(data, starts, ends), first


def phrases(prefix: np.ndarray, first: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor hash, content hash) of every phrase of texts laid end to end."""
    n = len(prefix) - 1
    hashes = WORDS.runs(prefix, gram)
    key = (hashes >> U64(32) << U64(32)) | np.arange(len(hashes), dtype=U64)
    anchor = (sliding_min(key, width - gram + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    at = np.flatnonzero(inside(first, n, width))
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(U64), none.view(U64)
    own = anchor[at]
    head = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)])
    start, count = at[head], np.diff(np.r_[head, len(at)])
    text = np.searchsorted(first, start, "right") - 1
    # texts may be cut between equal anchors only where windows are, so a phrase lies in one text
    return text, start - first[text], count, hashes[own[head]], WORDS.stretch(prefix, start, start + count + width - 1)


def merged(doc: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows joined where they touch or overlap."""
    order = np.lexsort((place, doc))
    doc, place, end = doc[order], place[order], (place + n)[order]
    if not len(doc):
        return doc, place, end
    _, number = np.unique(doc, return_inverse=True)
    reach = np.maximum.accumulate(end + number * (1 << 40)) - number * (1 << 40)
    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] > reach[:-1])])
    last = np.r_[head[1:], len(doc)] - 1
    return doc[head], place[head], reach[last] - place[head]


def _batch(anchor, content, doc, place, n, many, state) -> pa.RecordBatch:  # noqa: ANN001
    return pa.record_batch([pa.array(np.asarray(anchor).view(np.int64)), pa.array(np.asarray(content).view(np.int64)), pa.array(doc), pa.array(place.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(many), pa.array(np.full(len(doc), state, np.int32))], names=_NAMES)


def _settled(doc: np.ndarray, place: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    doc, place, n = merged(doc, place, n)
    return _batch(doc, np.zeros(len(doc), np.int64), doc, place, n, np.ones(len(doc), bool), 1)


def _send(rule: str, anchor: np.ndarray, content: np.ndarray, doc: np.ndarray, place: np.ndarray, n: np.ndarray, many: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of a batch: what it can settle by itself, and of the rest what other batches must see.

    many: contents known to occur again (with "anywhere").
    """
    order = np.lexsort((place, doc, content, anchor))
    known = np.zeros(len(doc), bool) if many is None else many[order]
    anchor, content, doc, place, n = (x[order] for x in (anchor, content, doc, place, n))
    head = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])]) if len(doc) else np.zeros(0, int)
    size = np.diff(np.r_[head, len(doc)])
    if rule == "earlier":
        gone = doc > np.repeat(doc[head], size)
        many = np.zeros(len(doc), bool)
        sent = ~gone
    else:
        many = gone = np.repeat((size > 1) | (np.bitwise_or.reduceat(known, head) if len(head) else known), size)
        sent = np.zeros(len(doc), bool)
        sent[head] = True
    yield _batch(anchor[sent], content[sent], doc[sent], place[sent], n[sent], many[sent], 0)
    if gone.any():
        yield _settled(doc[gone], place[gone], n[gone])


def send_phrases(docs: DataFrame, units: Units, width: int, gram: int, rule: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for i, data, off in chunks(b.column(1), TOGETHER):
                values, first = units(data, off)
                text, place, n, anchor, content = phrases(WORDS.prefix(values), first, width, gram)
                yield from _send(rule, anchor, content, ids[i + text], place, n)

    return docs.select("doc_id", "text").where(F.col("doc_id").isNotNull()).mapInArrow(run, ROW)


def send_windows(docs: DataFrame, which: DataFrame, units: Units, width: int, rule: str) -> DataFrame:
    """Each window of the stretches (doc_id, place, n, many) as a phrase of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(b.column(2).is_valid())
            ids = b.column(0).to_numpy()
            for i, data, off in chunks(b.column(1)):
                values, first = units(data, off)
                row, place, n, many = stretches(b.column(2), i, first, width)
                at = ranges(first[row] + place, n)
                h = WORDS.runs(WORDS.prefix(values), width)[at]
                row, many = np.repeat(row, n), np.repeat(many, n)
                doc, place = ids[i + row], at - first[row]
                yield from _send(rule, h, h, doc, place, np.ones(len(h), np.int64), many if rule == "anywhere" else None)

    return with_stretches(docs, which).mapInArrow(run, ROW)


def with_stretches(docs: DataFrame, which: DataFrame) -> DataFrame:
    """(doc_id, text, spans) of every document, its stretches in one list, as long as the document at most.

    All documents are kept, so that every join of the texts is the same and they are shuffled once.
    """
    spans = which.groupBy("doc_id").agg(F.collect_list(F.struct("place", "n", "many", "anchor")).alias("spans"))
    return docs.select("doc_id", "text").join(spans, "doc_id", "left").select("doc_id", "text", "spans")


def stretches(spans: pa.Array, i: int, first: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(row, place, n, many) of the lists of rows i.. of a batch, cut to the windows that the texts have."""
    part = spans.slice(i, len(first) - 1)
    row = pc_parents(part)
    flat = part.flatten()
    place, n, many = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    place = place.astype(np.int64)
    n = np.clip(np.minimum(n, np.diff(first)[row] - width + 1 - place), 0, None).astype(np.int64)
    return row, place, n, many


def pc_parents(lists: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _read(rule: str, rows: list[np.ndarray], mixed: bool, last: bool) -> tuple[list[pa.RecordBatch], list[np.ndarray], bool]:
    """Settle sorted open rows; the rows of the last content are kept for what may follow.

    mixed: the first anchor had another content before these rows.
    """
    anchor, content, doc, place, n, many = rows
    head = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])])
    size = np.diff(np.r_[head, len(doc)])
    top = np.flatnonzero(np.r_[True, anchor[head][1:] != anchor[head][:-1]])  # contents that begin an anchor
    kinds = np.diff(np.r_[top, len(head)])
    several = kinds > 1
    several[0] |= mixed
    group = np.repeat(np.arange(len(head)), size)
    is_mixed = np.repeat(np.repeat(several, kinds), size)
    if rule == "earlier":
        gone = doc > doc[head][group]
        stays = ~gone
    else:
        again = (size > 1) | np.bitwise_or.reduceat(many, head)
        gone = again[group]
        stays = np.zeros(len(doc), bool)
        stays[head] = True
        many = gone
    held = group == len(head) - 1 if not last else np.zeros(len(doc), bool)
    out = [_settled(doc[gone], place[gone], n[gone])] if gone.any() else []
    compare = stays & is_mixed & ~held
    if compare.any():
        out.append(_batch(anchor[compare], content[compare], doc[compare], place[compare], n[compare], many[compare], 2))
    keep = held & stays
    return out, [x[keep] for x in (anchor, content, doc, place, n, many)], bool(several[-1]) if not last else False


def settle(sent: DataFrame, rule: str) -> DataFrame:
    """Settled stretches (state 1) and phrases to be compared window by window (state 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, mixed = None, False
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            done = cols[6] == 1
            if done.any():
                yield b.filter(pa.array(done))
            rows = [c[~done] for c in cols[:6]]
            if not len(rows[0]):
                continue
            if carry is not None:
                rows = [np.concatenate([x, y]) for x, y in zip(carry, rows, strict=True)]
            out, carry, mixed = _read(rule, rows, mixed, False)
            yield from out
        if carry is not None:
            yield from _read(rule, carry, mixed, True)[0]

    dealt = sent.repartition("anchor").sortWithinPartitions("state", "anchor", "content", "doc_id", "place")
    return dealt.mapInArrow(run, ROW)
