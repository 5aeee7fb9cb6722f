"""MinHash near-dedup by a chosen-path set similarity join (operator 2).

A document is its set of distinct five-word shingles. Sets are embedded into ``POSITIONS``
minwise tokens. A tree branches a record at a node on a random choice of positions, the same for
all records at that node: each position is chosen with probability 1 / (THRESHOLD * POSITIONS),
and the child is the node's path plus the record's token there, so that two records with
the threshold's similarity share one child on average. Small nodes are compared exhaustively,
large ones branch again, and ``TREES`` independent trees bring the recall up.

Equal sets are one record, and records already in one component need no further comparison: what a
node costs is its *others*, the records outside its largest component. Nodes with ``SMALL`` others at most
are compared, others against all; larger ones first meet one pivot, the record that agrees best with
the majority of the node's sketches (in a group of copies that is the text they were copied from),
and branch on with what that leaves open. Comparing is done in blocks, mostly a node each: records are dealt to
blocks of bounded size by hash where one is not enough (the others are sent to each). The sketches of a block
say which of its records have a possible partner at all. A pair that shares several compared nodes
on the first level is tested in the first of them alone, which the records' own lists of nodes tell; only records with
a pair left go on with their texts, each once a block whatever the number of its pairs. A task counts all common shingles
of a block and gives one link for each record that it joined to another component, not one a pair.

Recall: links are confirmed on full sets, so none is false. A linked pair is lost if none of the
trees brings it into a common node that is compared, or if its sketches differ too much (``SKETCH_DIFFERS``; below 1e-3
at the threshold). The target is 0.9 of the pairs at exactly 0.75 at any depth; tests measure it on planted pairs in
deep nodes. A component loses a member only if all its links are lost.

``doc_id`` is a bigint. Null texts and texts without words have an empty set: linked with nothing, their own component.
Repeated rows of one id count as one document with the union of their sets' rows kept apart by
set: they share the id and so the component. Rows without an id are left out of the links. No rows give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import bloom
from llm.components import components
from llm.textnum import WORDS, chunks, inside, lower_ascii, mix, ranges, word_hashes, words
from tablewatch.session import cut_lineage

SHINGLE = 5
#: similarity as a ratio of integers
SIMILAR = (75, 100)
POSITIONS = 64
TREES = 12
#: A node is compared where so many of its records at most are outside its largest component.
SMALL = 2560
#: Shingles and records that a block holds about at most; hash decides, and one record may have more.
BLOCK_SHINGLES, BLOCK_RECORDS = 1 << 19, 2560
#: Slot of the nodes below the first level; a node of the first level has tree * POSITIONS + position.
DEEP = 1 << 20
#: Bits of the filter of nodes on the first level that are not compared.
OPEN_BITS = 1 << 20
#: positions of 64 whose two-bit sketches may differ
SKETCH_DIFFERS = 22
#: Buckets of document ids that the join with texts tells apart before it moves texts: what is broadcast holds so many rows at most.
BUCKETS = 1 << 20

_rng = np.random.default_rng(2024)
_FACTORS = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ROOTS = _rng.integers(0, 1 << 63, TREES, dtype=np.int64).astype(np.uint64)
_CHOSEN = np.uint64(int((1 << 64) / (SIMILAR[0] / SIMILAR[1] * POSITIONS)))


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, distinct shingle hashes text by text and sorted in each, offsets)."""
    for i, data, off in chunks(texts):
        data = lower_ascii(data)
        starts, ends, first = words(data, off)
        prefix = WORDS.prefix(word_hashes(data, starts, ends))
        n = np.diff(first)
        h = WORDS.runs(prefix, SHINGLE)
        ok = inside(first, len(starts), SHINGLE)
        text = np.repeat(np.arange(len(n)), n)[: len(ok)][ok]
        h = h[: len(ok)][ok]
        few = np.flatnonzero((n > 0) & (n < SHINGLE))
        if len(few):
            h = np.concatenate([h, WORDS.stretch(prefix, first[few], first[few + 1])])
            text = np.concatenate([text, few])
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        if len(h):
            new = np.r_[True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])]
            h, text = h[new], text[new]
        yield i, h, np.searchsorted(text, np.arange(len(n) + 1))


def _sum(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[off[1:]] - total[off[:-1]]


def minwise(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts with a set) x POSITIONS minwise tokens of 32 bits."""
    full = np.flatnonzero(np.diff(off))
    out = np.empty((len(full), POSITIONS), np.uint32)
    for p in range(POSITIONS):
        out[:, p] = np.minimum.reduceat((h * _FACTORS[p] >> np.uint64(32)).astype(np.uint32), off[:-1][full]) if len(full) else 0
    return out


def children(path: np.ndarray, used: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, keys and used positions of the children of records; a path takes no position twice.

    Without that, a token that very many unlike records share would keep them together at every depth.
    """
    choice = mix(path[:, None] ^ mix(np.arange(1, POSITIONS + 1, dtype=np.uint64))[None, :])
    bit = np.uint64(1) << np.arange(POSITIONS, dtype=np.uint64)
    row, at = np.nonzero((choice < _CHOSEN) & (used[:, None] & bit == 0))
    return row, mix(choice[row, at] + tokens[row, at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), used[row] | bit[at]


_SKETCH = "doc_id long, n long, set1 long, set2 long, bit0 long, bit1 long, tokens binary, nodes array<struct<node: long, used: long, slot: long>>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, h, off in shingle_sets(b.column(1)):
            n = np.diff(off)
            full = np.flatnonzero(n)
            tokens = minwise(h, off)
            set1, set2 = _sum(mix(h), off), _sum(mix(h ^ np.uint64(0x5851F42D4C957F2D)), off)
            bits = [np.packbits((tokens >> k & 1).astype(np.uint8), axis=1).view("<i8").ravel() for k in (0, 1)]
            kids = [children(np.full(len(full), root), np.zeros(len(full), np.uint64), tokens) for root in _ROOTS]
            tree = np.repeat(np.arange(TREES), [len(k[0]) for k in kids])
            row, key, used = (np.concatenate(x) for x in zip(*kids, strict=True))
            slot = tree * POSITIONS + np.bitwise_count(used - np.uint64(1)).astype(np.int64)  # one position is used so far
            order = np.argsort(row, kind="stable")
            node = pa.StructArray.from_arrays([pa.array(key[order].view(np.int64)), pa.array(used[order].view(np.int64)), pa.array(slot[order])], names=["node", "used", "slot"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[order], np.arange(len(full) + 1)).astype(np.int32)), node)
            ids = b.column(0).slice(i, len(n))
            spread = np.full(len(n), -1)
            spread[full] = np.arange(len(full))
            take = pa.array(spread, mask=spread < 0)
            cols = [pa.array(bits[0]), pa.array(bits[1]), pa.array([t.tobytes() for t in tokens], pa.binary()), lists]
            yield pa.record_batch([ids, pa.array(n.astype(np.int64)), pa.array(set1.view(np.int64)), pa.array(set2.view(np.int64)), *(c.take(take) for c in cols)], names=[x.split()[0] for x in re.split(", (?!used|slot)", _SKETCH)])


_BLOCK = "block long, rec long, comp long, other boolean, n long, set1 long, bit0 long, bit1 long, slot long"
_BLOCK_NAMES = [x.split()[0] for x in _BLOCK.split(", ")]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, in tables that hold whole groups; a block that goes on waits."""
    wait: list[pa.Table] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        t = pa.Table.from_batches([b])
        if cut or (wait and wait[-1].column(0)[0].as_py() != key[0]):
            yield pa.concat_tables([*wait, t.slice(0, cut)])
            wait = []
        wait.append(t.slice(cut))
    if wait:
        yield pa.concat_tables(wait)


def _pairs(cols: list[np.ndarray], differs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one block, one of them another, whose sizes and sketches allow the similarity; about a quarter of a million tested at once."""
    block, _, comp, other, n, _, bit0, bit1, _ = cols
    left = np.searchsorted(block, block, "right") - np.arange(len(block)) - 1
    lo, upto = 0, np.cumsum(left)
    while lo < len(block):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + (1 << 18))))
        i = np.repeat(np.arange(lo, hi), left[lo:hi])
        j = ranges(np.arange(lo, hi) + 1, left[lo:hi])
        ok = (other[i] | other[j]) & (comp[i] != comp[j])
        ok &= SIMILAR[1] * np.minimum(n[i], n[j]) >= SIMILAR[0] * np.maximum(n[i], n[j])
        i, j = i[ok], j[ok]
        ok = np.bitwise_count((bit0[i] ^ bit0[j] | bit1[i] ^ bit1[j]).view(np.uint64)) <= differs
        yield i[ok], j[ok]
        lo = hi


def _numbers(t: pa.Table) -> list[np.ndarray]:
    return [t.column(k).to_numpy() for k in range(len(_BLOCK_NAMES))]


def _active(differs: int):
    """The rows of blocks that have a possible partner there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            keep = np.zeros(t.num_rows, bool)
            for i, j in _pairs(_numbers(t), differs):
                keep[i] = keep[j] = True
            yield from t.filter(pa.array(keep)).to_batches()

    return run


def _nodes(differs: int, records: int, shingles: int):
    """Rows sorted by node -> the rows with a possible partner of nodes that are one block, and all rows of larger nodes (big).

    A larger node passes through row by row as soon as it is known to be one.
    """

    def small(t: pa.Table) -> Iterator[pa.RecordBatch]:
        cols = [c.to_numpy() for c in t.columns]
        node, _, slot, rec, n, set1, bit0, bit1, comp = cols
        keep = np.zeros(t.num_rows, bool)
        for i, j in _pairs([node, rec, comp, np.ones(len(node), bool), n, set1, bit0, bit1, slot], differs):
            keep[i] = keep[j] = True
        yield from marked(t.filter(pa.array(keep)), False)

    def marked(t: pa.Table, big: bool) -> Iterator[pa.RecordBatch]:
        yield from t.append_column("big", pa.array(np.full(t.num_rows, big))).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: list[pa.Table] = []  # the node being read, while it may be one block
        held = weight = 0
        open_node = None  # a larger node being read
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            if wait and t.column(0)[0].as_py() == wait[-1].column(0)[0].as_py():
                t = pa.concat_tables([*wait, t])
            elif wait:
                yield from small(pa.concat_tables(wait))
            wait, held, weight = [], 0, 0
            node, n = t.column(0).to_numpy(), t.column(4).to_numpy()
            first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            size, total = np.diff(np.r_[first, len(node)]), np.add.reduceat(n, first)
            big = (size > records) | (total > shingles) | (node[first] == open_node if open_node is not None else False)
            of_row = np.repeat(big, size)
            last = slice(first[-1], len(node))
            of_small = ~of_row
            if not big[-1]:
                of_small[last] = False
                wait = [t.slice(first[-1])]
                open_node = None
            else:
                open_node = node[-1]
            yield from marked(t.filter(pa.array(of_row)), True)
            yield from small(t.filter(pa.array(of_small)))
        if wait:
            yield from small(pa.concat_tables(wait))

    return run


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column, without those that are alone."""
    last = None  # the row before the batch, and whether it is known to have company
    company = False
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b] if last is None else [last, b])
        key = t.column(0).to_numpy()
        same = key[1:] == key[:-1]
        keep = np.zeros(len(key), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= company
        company = bool(keep[-1])
        keep[-1] = False  # decided with the next batch
        yield from t.filter(pa.array(keep)).combine_chunks().to_batches()
        last = t.slice(t.num_rows - 1).combine_chunks().to_batches()[0]
    if company:
        yield last


def _unmet(differs: int, open_: np.ndarray):
    """Rows of blocks with their record's nodes on the first level -> rows with a pair that shares no earlier compared node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            cols = _numbers(t)
            nodes = t.column(len(_BLOCK_NAMES)).combine_chunks()
            row = pc.list_parent_indices(nodes).to_numpy().astype(np.int64)
            flat = nodes.flatten()
            key, slot = flat.field(0).to_numpy(), flat.field(2).to_numpy()
            slots, column = np.unique(slot, return_inverse=True)
            key = np.where(bloom.maybe(open_, key), row, key)  # a node that is not compared is like no other's
            table = np.broadcast_to(np.arange(t.num_rows)[:, None], (t.num_rows, len(slots))).copy()
            table[row, column] = key
            keep = np.zeros(t.num_rows, bool)
            for i, j in _pairs(cols, differs):
                met = np.zeros(len(i), bool)
                for c, s in enumerate(slots):
                    met |= (table[i, c] == table[j, c]) & (s < cols[8][i])
                keep[i[~met]] = keep[j[~met]] = True
            yield from t.select(_BLOCK_NAMES).filter(pa.array(keep)).to_batches()

    return run


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets (distinct sorted values) have in common.

    Values that one set alone has are left out. The rest is counted by lists of the sets that hold a
    value, or by products of 0/1 matrices, a few thousand values at a time, whichever is less work.
    """
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    _, value, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = count[value] > 1
    owner, value = owner[kept], (np.cumsum(count > 1) - 1)[value[kept]]
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    total = np.zeros(m * m, np.int64)
    if not len(value):
        return total.reshape(m, m)
    first = np.searchsorted(value, np.arange(value[-1] + 2))
    size = np.diff(first)
    if int((size * size).sum()) * 16 < m * m * len(size):
        lo, upto = 0, np.cumsum(size * size)
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + (1 << 19))))
            rows = np.arange(first[lo], first[hi])
            wide = size[value[rows]]
            total += np.bincount(np.repeat(owner[rows], wide) * m + owner[ranges(first[value[rows]], wide)], minlength=m * m)
            lo = hi
        return total.reshape(m, m)
    out = np.zeros((m, m), np.float32)
    for lo in range(0, len(size), 4096):
        rows = slice(first[lo], first[min(lo + 4096, len(size))])
        part = np.zeros((m, min(4096, len(size) - lo)), np.float32)
        part[owner[rows], value[rows] - lo] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _joined(comp: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each row the first row that links and equal components lead to."""
    _, first, back = np.unique(comp, return_index=True, return_inverse=True)
    label = first[back]
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        least = np.full(len(first), len(comp))
        np.minimum.at(least, back, new)
        new = least[back]
        if (new == label).all():
            return label
        label = new


def _links(differs: int):
    """Blocks with texts -> links (a, b) that join the components of a block on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            sets: list[np.ndarray] = []
            for _, h, off in shingle_sets(t.column(len(_BLOCK_NAMES))):
                sets += np.split(h, off[1:-1])
            # An id with several texts came with each of them: only that of the record counts.
            set1 = np.array([int(np.sum(mix(h), dtype=np.uint64)) for h in sets], np.uint64).view(np.int64)
            own = np.flatnonzero(set1 == t.column("set1").to_numpy())
            sets, cols = [sets[k] for k in own], [c[own] for c in _numbers(t)]
            block, rec, comp, n = cols[0], cols[1], cols[2], cols[4]
            found = list(_pairs(cols, differs))
            i, j = (np.concatenate([p[k] for p in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            a, b = [], []
            name, begin = np.unique(block[i], return_index=True)  # pairs come block by block
            for s, e in zip(begin, np.append(begin[1:], len(i)), strict=True):
                lo, hi = np.searchsorted(block, block[i[s]]), np.searchsorted(block, block[i[s]], "right")
                x, y = i[s:e] - lo, j[s:e] - lo
                both = common(sets[lo:hi])[x, y]
                ok = SIMILAR[1] * both >= SIMILAR[0] * (n[lo:hi][x] + n[lo:hi][y] - both)
                label = _joined(comp[lo:hi], x[ok], y[ok])
                other = np.flatnonzero(comp[lo:hi] != comp[lo:hi][label])
                a.append(comp[lo:hi][label][other])
                b.append(comp[lo:hi][other])
            a, b = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, b))
            yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block", "rec")


def compare(active: DataFrame, docs: DataFrame, nodes: DataFrame, open_: np.ndarray, differs: int) -> DataFrame:
    """Links (a, b) between components from rows of blocks, confirmed on the documents' full sets.

    nodes: (rec, set1, nodes) of all records; open_: filter of those nodes that are not compared.
    """
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS)).alias("bucket")

    def of(rows: DataFrame, there: DataFrame) -> DataFrame:
        """The rows (rec, ...) that may be needed, found before they are moved."""
        needed = there.select(bucket("rec")).distinct()
        return rows.withColumn("bucket", bucket("rec")).join(F.broadcast(needed), "bucket", "left_semi").drop("bucket")

    listed = active.join(of(nodes, active), ["rec", "set1"]).select(*_BLOCK_NAMES, "nodes")
    left = cut_lineage(_dealt(listed).mapInArrow(_unmet(differs, open_), _BLOCK))
    text = of(docs.select(F.col("doc_id").alias("rec"), "text"), left)
    return _dealt(left.join(text, "rec").select(*_BLOCK_NAMES, "text")).mapInArrow(_links(differs), "a long, b long").distinct()


def _sizes(named: DataFrame) -> DataFrame:
    """(node, major, records, others, shingles, other_shingles) of nodes with several components; major is the largest one."""
    parts = named.groupBy("node", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    whole = parts.groupBy("node").agg(F.sum("c").alias("records"), F.sum("w").alias("shingles"), F.max(F.struct("c", "w", "comp")).alias("top"))
    whole = whole.withColumn("others", F.col("records") - F.col("top.c")).where("others > 0")
    return whole.select("node", F.col("top.comp").alias("major"), "records", "others", "shingles", (F.col("shingles") - F.col("top.w")).alias("other_shingles"))


def _parts(records: str, shingles: str):
    """How many blocks hold so much."""
    return F.greatest(F.lit(1), F.ceil(F.col(records) / F.lit(BLOCK_RECORDS)), F.ceil(F.col(shingles) / F.lit(BLOCK_SHINGLES))).cast("long")


def _deal(rows: DataFrame) -> DataFrame:
    """Blocks of rows (node, rec, comp, other, n, ..., records, others, shingles, other_shingles): every other one of a node meets all its records.

    A node that fits is one block. Otherwise all records are dealt to ``wide`` and the others to ``high`` parts by
    hash, a block for each two parts.
    """
    rows = rows.withColumn("wide", _parts("records", "shingles")).withColumn("high", F.when(F.col("wide") == 1, F.lit(1).cast("long")).otherwise(_parts("others", "other_shingles")))
    at = lambda i, j, other: F.struct(F.xxhash64("node", i, j).alias("block"), other.alias("other"))
    mine, own = F.pmod(F.xxhash64("rec"), F.col("wide")), F.pmod(F.xxhash64("rec", F.lit(1)), F.col("high"))
    as_all = F.transform(F.sequence(F.lit(0).cast("long"), F.col("high") - 1), lambda i: at(i, mine, F.lit(False)))
    as_other = F.transform(F.sequence(F.lit(0).cast("long"), F.col("wide") - 1), lambda j: at(own, j, F.lit(True)))
    one = F.array(at(F.lit(0).cast("long"), F.lit(0).cast("long"), F.col("other")))
    places = F.when(F.col("wide") == 1, one).when(F.col("other"), F.concat(as_all, as_other)).otherwise(as_all)
    return rows.withColumn("place", F.explode(places)).select(F.col("place.block").alias("block"), "rec", "comp", F.col("place.other").alias("other"), "n", "set1", "bit0", "bit1", "slot")


def _majority(rows: DataFrame) -> DataFrame:
    """(node, most0, most1): the bits that most sketches of a node have."""
    sums = [F.sum(F.shiftright(F.col(b), k).bitwiseAND(F.lit(1))) for b in ("bit0", "bit1") for k in range(64)]
    totals = rows.groupBy("node").agg(F.count("*").alias("size"), F.array(*sums).alias("ones"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ones = np.stack([np.asarray(x) for x in b.column(2).to_pylist()])
                bits = np.packbits((2 * ones > b.column(1).to_numpy()[:, None]).reshape(-1, 2, 64)[:, :, ::-1], axis=2).view(">i8").reshape(-1, 2).astype(np.int64)
                yield pa.record_batch([b.column(0), pa.array(bits[:, 0]), pa.array(bits[:, 1])], names=["node", "most0", "most1"])

    return totals.mapInArrow(run, "node long, most0 long, most1 long")


def _measured(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows of the nodes of ``sizes``, with the parts of their node (wide) and how far each is from the majority (apart)."""
    node = _majority(rows).join(sizes.select("node", _parts("records", "shingles").alias("wide")), "node")
    apart = F.bit_count(F.col("bit0").bitwiseXOR(F.col("most0")).bitwiseOR(F.col("bit1").bitwiseXOR(F.col("most1"))))
    return rows.join(node, "node").withColumn("apart", apart).drop("most0", "most1")


def _exhaustive(named: DataFrame, sizes: DataFrame) -> DataFrame:
    """Blocks in which the others of small nodes meet all records."""
    return _deal(named.join(sizes, "node").withColumn("other", F.col("comp") != F.col("major")))


def _stars(measured: DataFrame) -> DataFrame:
    """Blocks in which the pivot of each large node, the record nearest to its majority, meets all records."""
    own = ["rec", "comp", "n", "set1", "bit0", "bit1", "slot", "wide"]
    pivots = measured.groupBy("node").agg(F.min(F.struct("apart", *own)).alias("best")).select("node", *(f"best.{c}" for c in own))
    there = lambda part, other: (F.xxhash64("node", part).alias("block"), "rec", "comp", F.lit(other).alias("other"), "n", "set1", "bit0", "bit1", "slot")
    every = measured.select(*there(F.pmod(F.xxhash64("rec"), F.col("wide")), False))
    pivots = pivots.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("wide") - 1)))
    return every.unionByName(pivots.select(*there(F.col("part"), True)))


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        path, used = (b.column(k).to_numpy().view(np.uint64) for k in (0, 1))
        tokens = np.frombuffer(b"".join(b.column(b.num_columns - 1).to_pylist()), np.uint32).reshape(-1, POSITIONS)
        row, key, used = children(path, used, tokens)
        kept = b.select(range(2, b.num_columns - 1)).take(pa.array(row))
        yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(used.view(np.int64)), *kept.columns], names=b.schema.names[:-1])


_KINDS = "node long, used long, slot long, rec long, n long, set1 long, bit0 long, bit1 long"
_RECORD = [x.split()[0] for x in _KINDS.split(", ")]


def near_duplicates(docs: DataFrame, small: int = SMALL, differs: int = SKETCH_DIFFERS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; component_id is the smallest id reachable."""
    sketch = cut_lineage(docs.select("doc_id", "text").mapInArrow(_sketch, _SKETCH))
    # Equal sets have equal sketches: a record takes any of its documents', and the least id.
    same = [F.first(c).alias(c) for c in ("bit0", "bit1", "tokens", "nodes")]
    record = cut_lineage(sketch.where("n > 0 and doc_id is not null").groupBy("set1", "set2", "n").agg(F.min("doc_id").alias("rec"), *same))
    members = cut_lineage(sketch.select("doc_id", "n", "set1", "set2").join(record.select("set1", "set2", "n", "rec"), ["set1", "set2", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rec", "doc_id").alias("rec")))
    comp = None

    def named(rows: DataFrame) -> DataFrame:
        """Rows with the component of their record, as far as it is known."""
        rows = rows.select(*_RECORD)
        if comp is None:
            return rows.withColumn("comp", F.col("rec"))
        return rows.join(comp.withColumnRenamed("node", "rec"), "rec", "left").withColumn("comp", F.coalesce("component", "rec")).drop("component")

    def link(active: DataFrame) -> None:
        """Compare blocks; components take in what was found."""
        nonlocal comp
        new = cut_lineage(compare(active, docs, record.select("rec", "set1", "nodes"), open_nodes, differs))
        if not new.isEmpty():
            old = [] if comp is None else [comp.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))]
            comp = cut_lineage(components(reduce(DataFrame.unionByName, old, new)))

    def active_in(blocks: DataFrame) -> DataFrame:
        return _dealt(blocks.select(*_BLOCK_NAMES)).mapInArrow(_active(differs), _BLOCK)

    # The first level moves keys alone until it is known which nodes have two records.
    thin = record.select("rec", "set1", F.inline("nodes")).select("node", "used", "slot", "rec", "set1")
    shared = thin.repartition("node").sortWithinPartitions("node").mapInArrow(_several, "node long, used long, slot long, rec long, set1 long")
    level = named(shared.join(record.select("rec", "set1", "n", "bit0", "bit1"), ["rec", "set1"]))
    open_nodes = None
    while True:
        dealt = level.select(*_RECORD, "comp").repartition("node").sortWithinPartitions("node", "rec")
        read = cut_lineage(dealt.mapInArrow(_nodes(differs, min(small + 1, BLOCK_RECORDS), BLOCK_SHINGLES), f"{_KINDS}, comp long, big boolean"))
        rows = read.where("big").drop("big")
        sizes = cut_lineage(_sizes(rows))
        few, many = sizes.where(F.col("others") <= small), sizes.where(F.col("others") > small)
        if open_nodes is None:
            open_nodes = bloom.build(many, "node", OPEN_BITS)
        whole = read.where("not big").select(F.col("node").alias("block"), "rec", "comp", F.lit(True).alias("other"), "n", "set1", "bit0", "bit1", "slot")
        if many.isEmpty():
            link(whole.unionByName(active_in(_exhaustive(rows, few))))
            break
        large = cut_lineage(_measured(rows, many))
        link(whole.unionByName(active_in(_exhaustive(rows, few).unionByName(_stars(large)))))
        # What the pivots have left open: compared now, or branched on.
        rows = cut_lineage(named(large).withColumn("slot", F.lit(DEEP).cast("long")))
        sizes = cut_lineage(_sizes(rows))
        few, many = sizes.where(F.col("others") <= small), sizes.where(F.col("others") > small)
        if not few.isEmpty():
            link(active_in(_exhaustive(rows, few)))
        if many.isEmpty():
            break
        rows = rows.join(many.select("node"), "node", "left_semi").select(*_RECORD)
        level = named(rows.join(record.select("rec", "set1", "tokens"), ["rec", "set1"]).select(*_RECORD, "tokens").mapInArrow(_branch, _KINDS).distinct())
    # A document id with several rows belongs to each of its records.
    same = members.where("rec <> doc_id").select(F.col("doc_id").alias("a"), F.col("rec").alias("b")).distinct()
    several = members.groupBy("doc_id").agg(F.min("rec").alias("least"), F.max("rec").alias("most")).where("least <> most")
    if several.isEmpty():  # then an id has the component of its one record
        whole = members if comp is None else members.join(comp.withColumnRenamed("node", "rec"), "rec", "left")
        found = F.col("rec") if comp is None else F.coalesce("component", "rec")
        return whole.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), found).alias("component_id"))
    every = components(same if comp is None else comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(same))
    return members.join(every.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op2(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without all but one of each near-duplicate group, columns unchanged; rows without id stay."""
    dropped = near_duplicates(docs).where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
