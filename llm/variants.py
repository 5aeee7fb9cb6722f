"""Spelling variant grouping by reduced-alphabet generation (operator 12).

Words and their counts come from all texts. Letters are hashed to ``SYMBOLS`` symbols, which
reduces a word to a short string over them. Words one edit apart have reduced words that are equal
or one edit apart, so the full one-edit neighbourhood of every distinct reduced word (deletions,
replacements and insertions over the small alphabet, and the word itself) is generated and
joined with the reduced vocabulary (a Bloom filter of fixed size drops most strings that it does not
hold before the shuffle); the words behind both sides are verified on the original
strings. A pair of words is met once, because a neighbourhood is a set and a word has one reduction.

A word's form is its near word of largest count, where that is at least ``RATIO`` times its own.
Counts grow by that factor along a chain of forms, so the root is found by doubling in a number of
joins that the largest count bounds.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. The planted
typing errors of the contract (``typos``) are a parameter: where the crc32 of ``<doc_id>:<word>`` is
a multiple of 199, one letter goes.

Defined results: null and empty texts have no words; a null id is written as nothing before the
colon; rows of one id count apart; no words give no rows; extra columns are ignored. A very long
run is a word like any other (its neighbourhood is as long as the word times twice the alphabet).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import bloom
from llm.textnum import BYTES, chunks, mix, ranges
from tablewatch.session import cut_lineage

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: A typing error is planted where the crc32 is a multiple of this; None plants none.
TYPOS = 199
SYMBOLS = 16
#: Bits of the filter that drops neighbours before they are joined with the reduced vocabulary.
BITS = 1 << 23
#: Bytes of text whose words are counted together before the shuffle.
TOGETHER = 4 << 20

#: Symbol of each letter (code points below 256): a hash of the letter.
_SYMBOL = (mix(np.arange(256, dtype=np.uint64) + np.uint64(7)) % np.uint64(SYMBOLS)).astype(np.uint8)


def _letters() -> np.ndarray:
    """Letter of each byte of UTF-8 text in lower case, as a code point below 256; 0 is none.

    The bytes behind 0xC3 are U+00C0 to U+00FF; see ``runs``.
    """
    table = np.zeros(256, np.uint8)
    for upper, lower in zip(range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1), strict=True):
        table[upper] = table[lower] = lower
    return table


_LETTER = _letters()


def _crc_table() -> np.ndarray:
    """Remainders of all bytes for the reflected CRC-32 polynomial 0xEDB88320."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1)
    return c.astype(np.uint32)


_CRC = _crc_table()


def runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letters, starts, ends, text) of the maximal runs of texts laid end to end; one item a letter."""
    wide = np.zeros(len(data), bool)  # the second byte of U+00C0 to U+00FF
    wide[1:] = data[:-1] == 0xC3
    letter = np.where(wide, data + np.uint8(0x40), _LETTER[data])
    letter[data == 0xC3] = 1  # the first byte joins its run and goes with the next line
    solid = letter > 0
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    keep = solid & (data != 0xC3)
    place = np.concatenate([[0], np.cumsum(keep)])
    return letter[keep], place[starts], place[ends], np.searchsorted(off, starts, "right") - 1


def crc32(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of each run in UTF-8, each going on from its seed."""
    wide = letters >= 0x80
    size = 1 + wide
    at = np.concatenate([[0], np.cumsum(size)])
    utf8 = np.empty(at[-1], np.uint8)
    utf8[at[:-1]] = np.where(wide, 0xC3, letters)
    utf8[at[:-1][wide] + 1] = letters[wide] - 0x40
    place, left = at[starts], at[ends] - at[starts]
    crc = seed ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-left, kind="stable")
    crc, place, left = crc[order], place[order], left[order]
    n = np.searchsorted(-left, -np.arange(left[0] if len(left) else 0), "left")  # runs longer than j
    for j, m in enumerate(n.tolist()):
        crc[:m] = _CRC[(crc[:m] ^ utf8[place[:m] + j]) & 0xFF] ^ crc[:m] >> np.uint32(8)
    out = np.empty_like(crc)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _typed(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, ids: list, typos: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs with the letter that a typing error loses taken out."""
    seed = np.array([zlib.crc32(f"{'' if k is None else k}:".encode()) for k in ids], np.uint32)
    h = crc32(letters, starts, ends, seed[text]).astype(np.int64)
    hit = np.flatnonzero(h % typos == 0)
    keep = np.ones(len(letters) + 1, bool)
    keep[starts[hit] + h[hit] % (ends - starts)[hit]] = False
    place = np.concatenate([[0], np.cumsum(keep[:-1])])
    return letters[keep[:-1]], place[starts], place[ends]


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, typos: int | None = TYPOS) -> DataFrame:
    """(word, n): the words of all texts with the length and count at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            for i, data, off in chunks(b.column(1), TOGETHER):
                letters, starts, ends, text = runs(data, off)
                if typos:
                    letters, starts, ends = _typed(letters, starts, ends, text, ids[i : i + len(off) - 1], typos)
                long = ends - starts >= min_length
                starts, ends = starts[long], ends[long]
                h = BYTES.stretch(BYTES.prefix(BYTES.table[letters]), starts, ends)
                _, first, n = np.unique(h, return_index=True, return_counts=True)
                raw = letters.tobytes()
                word = [raw[s:e].decode("latin-1") for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
                yield pa.record_batch([pa.array(word, pa.string()), pa.array(n)], names=["word", "n"])

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def neighbourhood(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every string at most one edit from each reduced word, without repeats in a row.

    A reduced word is sum(symbol + 1 times a power of the place), so an edit is a sum of prefixes.
    """
    base = np.uint64(0x9E3779B97F4A7C15 | 1)
    longest = int(sizes.max(initial=0)) + 2
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(longest, base)]))
    n = len(sizes)
    row = np.repeat(np.arange(n), sizes)
    place = ranges(np.zeros(n, np.int64), sizes)
    value = symbols[ranges(starts, sizes)].astype(np.uint64) + np.uint64(1)
    term = value * power[place]
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
    low = np.concatenate([[0], np.cumsum(sizes)])
    whole = upto[low[1:]] - upto[low[:-1]]
    head = upto[:-1] - upto[low[:-1]][row]  # before each place
    tail = whole[row] - head  # from each place on
    down = pow(int(base), -1, 1 << 64)
    rows, keys = [np.arange(n), row], [whole, head + (tail - term) * np.uint64(down)]
    for s in range(1, SYMBOLS + 1):
        rows.append(row)
        keys.append(whole[row] - term + np.uint64(s) * power[place])
        rows.append(row)
        keys.append(head + np.uint64(s) * power[place] + tail * base)
        rows.append(np.arange(n))
        keys.append(whole + np.uint64(s) * power[sizes])
    rows, keys = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
    return rows[new], keys[new]


def _reduced(words_: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, starts, sizes) of words of letters below U+0100."""
    raw = [w.encode("latin-1") for w in words_.to_pylist()]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    return _SYMBOL[np.frombuffer(b"".join(raw), np.uint8)], np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes


def _hashes(words_: pa.Array) -> np.ndarray:
    symbols, starts, sizes = _reduced(words_)
    base = np.uint64(0x9E3779B97F4A7C15 | 1)
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(sizes.max(initial=0)) + 1, base)]))
    term = (symbols.astype(np.uint64) + np.uint64(1)) * power[ranges(np.zeros(len(sizes), np.int64), sizes)]
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
    return upto[starts + sizes] - upto[starts]


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every word with each of its near words, from both sides."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array(_hashes(b.column(0)).view(np.int64))], names=["word", "n", "reduced"])

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reduced = b.column(1)
            symbols, starts, sizes = _reduced(b.column(0))
            lo = 0
            while lo < len(sizes):  # about a million neighbours at once
                upto = np.cumsum(sizes[lo:] + 1) * (2 * SYMBOLS + 1)
                hi = lo + max(1, int(np.searchsorted(upto, 1 << 20)))
                row, key = neighbourhood(symbols, starts[lo:hi], sizes[lo:hi])
                there = bloom.maybe(known, key)
                row, key = row[there], key[there]
                yield pa.record_batch([reduced.take(pa.array(lo + row)), pa.array(key.view(np.int64))], names=["reduced", "near"])
                lo = hi

    named = cut_lineage(vocabulary.select("word", "n").mapInArrow(reduce, "word string, n long, reduced long"))
    known = bloom.build(named, "reduced", BITS)
    forms = named.groupBy("reduced").agg(F.min("word").alias("word"))
    around = forms.select("word", "reduced").mapInArrow(generate, "reduced long, near long")
    # Of the neighbours, those that the vocabulary holds; then the words behind both ends.
    there = around.join(named.select(F.col("reduced").alias("near")).distinct(), "near", "left_semi")
    left = named.join(there, "reduced").select("near", "word", "n")
    right = named.select(F.col("reduced").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return left.join(right, "near").where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def group(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n)."""
    vocabulary = cut_lineage(vocabulary)
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w")))
    near = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = vocabulary.join(near, "word", "left")
    takes = -F.col("best.m") >= ratio * F.col("n")
    rows = cut_lineage(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best.w")).alias("form"), F.when(takes, -F.col("best.m")).alias("form_n")))
    most = rows.agg(F.max("n")).first()[0] or 0
    steps = 0
    while ratio ** (steps + 1) <= most:  # forms follow one another at most so often
        steps += 1
    ahead = rows.where("form is not null").select("word", F.col("form").alias("root"))
    done = 1
    while done < steps:
        on = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = cut_lineage(ahead.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        done *= 2
    out = rows.join(ahead, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(docs: DataFrame) -> DataFrame:
    return group(words(docs))
