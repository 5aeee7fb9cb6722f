"""Quality rules by tokeniser fertility (operator 11).

Public vocabularies measure every text: characters per token, the share of tokens that are loose
bytes of other characters, and the entropy of its token distribution. Texts are compared with texts
of their own kind: the language, or the dominant script where no language is given, and the
class of length (powers of two of the token count). For each kind the quartiles of each measure
over all documents that the base rules pass give a rejection band, median -/+ ``REACH`` robust
standard deviations on either side; nothing is learnt from labels. Quartiles come from exact
histograms, so they need one small partial aggregate and do not depend on the order of rows. A kind
with fewer than ``ENOUGH`` different measurements takes the band of its language, and a language with
fewer that of all documents. Copies have equal measurements and count once.

Base rules: at least ``MIN_WORDS`` words, and at most half of them in three-word windows found twice
or more in the text.

Vocabularies encode word by word (each distinct word of a chunk once, with a blank before it), so
measures do not depend on white space. A path that ends in ``.model`` is a sentencepiece file, others
are rank files; every executor opens them (``files:NAME`` for one sent with ``addFile``).

Defined results: null, empty and blank texts have no words, fail the base rules and have null
measures; repeated rows give repeated results; without rows there are none; a null id stays null;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from llm.textnum import BYTES, WORDS, chunks, inside, ranges, word_hashes, words
from llm.tokenize import _local, encode_chunk, load_ranks
from tablewatch.session import cut_lineage

MIN_WORDS = 50
#: Robust standard deviations (1.4826 times the distance of a quartile from the median, scaled for a normal distribution).
REACH = 3.5
ENOUGH = 100
#: Bands that may be broadcast.
FEW_BANDS = 20_000
#: Bytes of text whose distinct words are encoded together.
TOGETHER = 4 << 20
#: Histogram bins a unit of each measure; a band is at least WIDTH units wide on either side.
BINS = {"chars_per_token": 256, "byte_share": 2048, "entropy": 128}
WIDTH = {"chars_per_token": 0.1, "byte_share": 0.02, "entropy": 0.25}

# Characters counted as symbols, and scripts as regular-expression classes.
SYMBOLS = "#*$%&|<>"
SCRIPTS = ["Latin", "Greek", "Cyrillic", "Hebrew", "Arabic", "Devanagari", "Thai", "Hangul", "Hiragana", "Katakana", "Han"]

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values between the bounds of each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[first])


def base_counts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of texts laid end to end."""
    n = len(off) - 1
    starts, ends, first = words(data, off)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = points[ends] - points[starts]
    # Lines: each text has one more than line feeds.
    feeds = np.flatnonzero(data == 0x0A)
    from_, to = np.sort(np.concatenate([off[:-1], feeds + 1])), np.sort(np.concatenate([feeds, off[1:]]))
    text = np.repeat(np.arange(n), _per_text(data == 0x0A, off) + 1)
    solid = np.searchsorted(starts, to) > np.searchsorted(starts, from_)
    text, h = text[solid], BYTES.stretch(BYTES.prefix(BYTES.table[data]), from_[solid], to[solid])
    order = np.lexsort((h, text))
    again = np.zeros(len(h), bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (text[order][1:] == text[order][:-1])
    dup = np.bincount(text[order][again], minlength=n)
    # Words in windows of three that are found twice or more.
    h = WORDS.runs(WORDS.prefix(word_hashes(data, starts, ends)), 3)
    at = np.flatnonzero(inside(first, len(starts), 3))
    text, h = np.repeat(np.arange(n), np.diff(first))[at], h[at]
    order = np.lexsort((h, text))
    same = (h[order][1:] == h[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[at[order][twice] + k] = True
    return np.diff(first), _per_text(chars, first), _per_text(_IS_SYMBOL[data], off), dup, _per_text(covered, first)


@lru_cache(4)
def _pieces(path: str):  # noqa: ANN202
    """(encoder of distinct words -> ids and counts, number of ids, which ids are loose bytes)."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            raw = data.tobytes()
            found = model.encode([raw[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], num_threads=1)
            counts = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter((i for ids in found for i in ids), np.int64, int(counts.sum())), counts

        return encode, model.get_piece_size(), np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    ranks = load_ranks(path)

    def encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = ends - starts + 1
        off = np.concatenate([[0], np.cumsum(size)])
        laid = np.full(off[-1], 0x20, np.uint8)
        laid[ranges(off[:-1] + 1, size - 1)] = data[ranges(starts, size - 1)]
        ids, at = encode_chunk(ranks, laid, off)
        return ids, np.diff(at)

    loose = np.zeros(ranks.size, bool)
    loose[ranks.single[128:]] = True
    return encode, ranks.size, loose


def fertility(data: np.ndarray, off: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, loose bytes among them, entropy of the tokens in bits) of texts laid end to end."""
    encode, size, loose = _pieces(path)
    starts, ends, first = words(data, off)
    _, example, back = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    ids, counts = encode(data, starts[example], ends[example])
    place = np.concatenate([[0], np.cumsum(counts)])
    n = counts[back]
    at = np.concatenate([[0], np.cumsum(n)])[first]
    ids = ids[ranges(place[back], n)]
    tokens = np.diff(at)
    pair, c = np.unique(np.repeat(np.arange(len(tokens)), tokens) * size + ids, return_counts=True)
    text = pair // size
    weight = np.bincount(text, c * np.log2(c), len(tokens)) / np.maximum(tokens, 1)
    return tokens, _per_text(loose[ids], at), np.where(tokens > 0, np.log2(np.maximum(tokens, 1)) - weight, 0.0)


_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def kind_of_text() -> Column:
    """The language, or the script with most letters (of equals the last by name); 'none' without letters."""
    counts = [F.struct(F.regexp_count("text", F.lit(rf"\p{{Is{s}}}")).alias("n"), F.lit(s).alias("name")) for s in SCRIPTS]
    top = F.greatest(*counts)
    script = F.when(F.coalesce(top["n"], F.lit(0)) > 0, F.concat(F.lit("script "), top["name"])).otherwise("script none")
    return F.when(F.col("lang").isNotNull(), F.col("lang")).otherwise(script)


def measure(docs: DataFrame, paths: Sequence[str]) -> DataFrame:
    """(doc_id, kind, length, base counts, and tokens<i>, loose<i>, entropy<i> of each vocabulary) of every text."""
    paths = tuple(paths)
    own = [f"{name}{i}" for i in range(len(paths)) for name in ("tokens", "loose", "entropy")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data, off in chunks(b.column(2), TOGETHER):
                cols = [pa.array(c.astype(np.int64)) for c in base_counts(data, off)]
                for p in paths:
                    tokens, loose, entropy = fertility(data, off, _local(p))
                    cols += [pa.array(tokens), pa.array(loose), pa.array(entropy)]
                n = len(off) - 1
                yield pa.record_batch([b.column(0).slice(i, n), b.column(1).slice(i, n), *cols], names=["doc_id", "kind", *_BASE, *own])

    rows = docs.select("doc_id", kind_of_text().alias("kind"), "text")
    kinds = ", ".join(f"{c} {'double' if c.startswith('entropy') else 'long'}" for c in [*_BASE, *own])
    out = rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, kind string, {kinds}")
    return out.withColumn("length", F.when(F.col("tokens0") > 0, F.floor(F.log2("tokens0"))).otherwise(F.lit(-1)).cast("int"))


def measures(n: int) -> dict[str, Column]:
    """The measures by n vocabularies, null for a text without tokens."""
    out = {}
    for i in range(n):
        some = F.when(F.col(f"tokens{i}") > 0, F.col(f"tokens{i}"))
        out |= {f"chars_per_token{i}": F.col("word_chars") / some, f"byte_share{i}": F.col(f"loose{i}") / some, f"entropy{i}": F.when(some.isNotNull(), F.col(f"entropy{i}"))}
    return out


def bands(measured: DataFrame, n: int, reach: float = REACH, enough: int = ENOUGH) -> DataFrame:
    """(kind, length, low and high of each measure in bins) for every kind and length among the rows."""
    named = measures(n)
    bins = {m: F.floor(c * BINS[m.rstrip("0123456789")]).cast("long") for m, c in named.items()}
    once = measured.select("kind", "length", *_BASE, *(f"{c}{i}" for i in range(n) for c in ("tokens", "loose")), *(c.alias(m) for m, c in bins.items())).distinct()
    levels = F.array(F.struct("kind", "length"), F.struct("kind", F.lit(None).cast("int").alias("length")), F.struct(F.lit(None).cast("string").alias("kind"), F.lit(None).cast("int").alias("length")))
    long = once.select("kind", "length", F.inline(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("bin")) for m in named))))
    hist = long.groupBy("kind", "length", "measure", "bin").agg(F.count("*").alias("c"))
    hist = hist.select(F.inline(levels).alias("a", "b"), "measure", "bin", "c").groupBy("a", "b", "measure", "bin").agg(F.sum("c").alias("c"))
    own = Window.partitionBy("a", "b", "measure")
    run = hist.withColumn("upto", F.sum("c").over(own.orderBy("bin"))).withColumn("total", F.sum("c").over(own))
    quarter = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bin")))
    q = run.groupBy("a", "b", "measure").agg(F.max("total").alias("total"), *(quarter(k).alias(f"q{k}") for k in (1, 2, 3)))
    floor = F.create_map(*(F.lit(x) for m in named for x in (m, WIDTH[m.rstrip("0123456789")] * BINS[m.rstrip("0123456789")])))[F.col("measure")]
    low = F.col("q2") - F.greatest(F.lit(reach * 1.4826) * (F.col("q2") - F.col("q1")), floor)
    high = F.col("q2") + 1 + F.greatest(F.lit(reach * 1.4826) * (F.col("q3") - F.col("q2")), floor)
    limits = [F.max(F.when(F.col("measure") == m, c)).alias(f"{side}_{m}") for m in named for side, c in (("low", low), ("high", high))]
    wide = q.groupBy("a", "b").agg(F.max("total").alias("total"), *limits)
    ends = [f"{side}_{m}" for m in named for side in ("low", "high")]
    level = lambda name, rows: rows.select("a", "b", F.struct("total", *ends).alias(name))
    each = level("own", wide.where("b is not null"))
    by_kind = level("kinds", wide.where("a is not null and b is null")).drop("b")
    alls = level("alls", wide.where("a is null")).first()  # one row: the band of all documents
    if alls is None:
        return wide.limit(0).select(F.col("a").alias("kind"), F.col("b").alias("length"), *ends)
    of_all = F.struct(*(F.lit(alls["alls"][c]).alias(c) for c in ("total", *ends)))
    picked = each.join(by_kind, "a")
    best = F.when(F.col("own.total") >= enough, F.col("own")).when(F.col("kinds.total") >= enough, F.col("kinds")).otherwise(of_all)
    return picked.select(F.col("a").alias("kind"), F.col("b").alias("length"), best.alias("band")).select("kind", "length", *(F.col(f"band.{e}").alias(e) for e in ends))


def judge(docs: DataFrame, paths: Sequence[str], reach: float = REACH, enough: int = ENOUGH) -> DataFrame:
    """Base counts, base_failed, kept, the measures, and which of them lie outside the bands."""
    rows = measure(docs, paths)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = cut_lineage(rows.withColumn("base_failed", failed))
    named = measures(len(paths))
    limits = bands(rows.where(~F.col("base_failed")), len(paths), reach, enough)
    limits = cut_lineage(limits)  # a row for each kind and length class, broadcast only if they are few
    joined = rows.join(F.broadcast(limits) if limits.count() <= FEW_BANDS else limits, ["kind", "length"], "left")
    outside = []
    for m, c in named.items():
        value = c * BINS[m.rstrip("0123456789")]
        outside.append(F.when((value < F.col(f"low_{m}")) | (value > F.col(f"high_{m}")), F.lit(m)))
    out = joined.withColumn("outside", F.array_compact(F.array(*outside)))
    kept = ~F.col("base_failed") & (F.size("outside") == 0)
    return out.select("doc_id", *_BASE, "base_failed", kept.alias("kept"), *(c.alias(m) for m, c in named.items()), F.when(~F.col("base_failed"), F.array_join("outside", ",")).alias("outside"))


def op11(docs: DataFrame, paths: Sequence[str]) -> DataFrame:
    return judge(docs, paths)
