"""Personal data by patterns and a character-level BiLSTM with CRF transitions (operator 7).

The patterns give the base spans. The network, trained in numpy on labelled spans, adds spans
that the patterns miss, such as phone numbers without a country code: overlapping windows are
tagged by Viterbi decoding, a window answers for the spans whose middle lies in its centre, and
the answers of all windows of a text are reconciled: spans that touch a base span or an earlier
span are dropped.

A span must hold a digit (an e-mail address: an at sign), and windows without either cannot
give one; only the others are tagged. Spans that the network proposes must also have the shape
of their kind (``plausible``).

Null and empty texts have no spans; repeated rows are answered alike; extra columns are kept
by ``redact`` and ignored by ``find``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from llm.crf import Tagger, train
from llm.textnum import CHUNK_BYTES

KINDS = ("email", "ip", "card", "phone")
#: Documents to take words for the training snippets from, at most (those of least hash).
FIT_ROWS = 300
FIT_SNIPPETS = 2400
WINDOW, STRIDE = 96, 48

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """As the whole pattern from left to right, but started at every at sign: linear in the text."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield "email", start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """The pattern spans by kind as listed, then start."""
    if not _TRIGGER.search(text):
        return []
    out = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def plausible(kind: str, s: str) -> bool:
    """The shape that a span proposed by the network must have."""
    digits = sum(c in "0123456789" for c in s)
    if kind == "email":
        return bool(re.fullmatch(r"[^\s@]+ ?@ ?[^\s@]+\.[^\s@.]+", s))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}", s)) and all(int(p) <= 255 for p in re.findall("[0-9]+", s))
    if kind == "card":
        return 16 <= digits <= 19 and bool(re.fullmatch(r"[0-9][0-9 ./-]+[0-9]", s)) and luhn("".join(re.findall("[0-9]", s)))
    return 9 <= digits <= 15 and bool(re.fullmatch(r"[+(]?[0-9][ ()./0-9-]+[0-9]", s)) and len(re.findall("[0-9]+", s)) >= 3


def _symbols(text: str) -> np.ndarray:
    """Network inputs: ASCII as it is, everything else as 127 (letters) or 0."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < 127, points, 127).astype(np.int16)


def windows(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an at sign; together they cover every such character."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    starts = set()
    for m in _TRIGGER.finditer(text):
        p = m.start()
        starts.update(range(max(0, -(-(p - WINDOW + 1) // STRIDE) * STRIDE), min(last, p // STRIDE * STRIDE) + 1, STRIDE))
    return sorted(starts)


def reconcile(text: str, base: list[Span], proposed: list[tuple[int, str, int, int]]) -> list[Span]:
    """Base spans and those proposals (window start, kind, start, end in the text) that stand.

    A window answers for spans whose middle is in its centre and that do not run over its edge.
    """
    taken = [(s, e) for _, s, e in base]
    added: list[Span] = []
    n = len(text)
    for w, kind, s, e in sorted(proposed, key=lambda x: (x[2], -x[3], x[0])):
        lo, hi = w + (WINDOW - STRIDE) // 2, w + (WINDOW + STRIDE) // 2
        middle = (s + e) / 2
        own = (lo <= middle or w == 0) and (middle < hi or w + WINDOW >= n)
        cut = (s == w and w > 0) or (e == w + WINDOW and e < n)
        if own and not cut and plausible(kind, text[s:e]) and not any(s < b and a < e for a, b in taken):
            taken.append((s, e))
            added.append((kind, s, e))
    return sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def tag(texts: list[str], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of every text; windows of all texts are decoded together."""
    base = [base_spans(t) for t in texts]
    where = [(i, w) for i, t in enumerate(texts) if t for w in windows(t)]
    proposed: dict[int, list] = {}
    for k in range(0, len(where), 512):
        part = where[k : k + 512]
        rows = np.zeros((len(part), WINDOW), np.int16)
        length = np.zeros(len(part), np.int64)
        for r, (i, w) in enumerate(part):
            s = _symbols(texts[i][w : w + WINDOW])
            rows[r, : len(s)], length[r] = s, len(s)
        for (i, w), spans in zip(part, tagger.spans(rows, length), strict=True):
            proposed.setdefault(i, []).extend((w, KINDS[k], w + s, w + e) for k, s, e in spans)
    return [(b, reconcile(t, b, proposed.get(i, [])) if i in proposed else b) for i, (t, b) in enumerate(zip(texts, base, strict=True))]


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _example(rng: np.random.Generator, words: list[str]) -> tuple[int | None, str]:
    """(kind or None, text) of a labelled span, or of a number that is no personal data."""
    d = lambda n: _digits(rng, n)
    w = lambda: re.sub(r"\W", "", words[rng.integers(len(words))]).lower() or "x"
    pick = lambda *x: x[rng.integers(len(x))]
    kind = pick(0, 0, 1, 2, 2, 3, 3, 3, None, None, None)
    if kind == 0:
        return 0, f"{w()}{pick('.', '', '_', '-')}{pick(w(), d(2), '')}{pick('@', '@', '@', ' @ ')}{pick('mail', w(), w())}{pick('', d(1))}.{pick('example.com', 'com', 'org', 'net', 'de', 'co.uk')}"
    if kind == 1:
        return 1, ".".join(str(rng.integers(1, 256)) for _ in range(4))
    if kind == 2:
        number = d(pick(15, 15, 15, 18))
        number += next(c for c in "0123456789" if luhn(number + c))
        gap = pick("", "", " ", "-", ".")
        return 2, gap.join(number[i : i + 4] for i in range(0, len(number), 4))
    if kind == 3:
        a, b, c = d(3), d(3), d(4)
        return 3, pick("+1 ", "+1-", f"+{rng.integers(20, 99)} ", "", "", "") + pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}", f"{a} {b} {c}")
    hexa = "".join(rng.choice(list("0123456789abcdef"), rng.integers(8, 40)))
    return None, pick(d(rng.integers(1, 20)), f"{rng.integers(1, 20)}.{d(1)}", f"{rng.integers(1, 9)}.{d(2)}.{d(1)}", f"{1900 + rng.integers(0, 130)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", f"password={hexa}", f'token = "{hexa}"', f"{d(2)}:{d(2)}", f"{d(2)},{d(3)}", f"{d(3)} {d(2)}", f"AKIA{hexa.upper()}", f"@{w()}", f"{d(1)}/{d(2)}", f"{rng.integers(1990, 2030)}")


def snippets(words: list[str], n: int, seed: int = 7) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled training texts of one window at most: corpus words with one to three examples between them."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.integers(1, 4)):
            text += "".join(words[rng.integers(len(words))] + " " for _ in range(rng.integers(0, 6)))
            kind, s = _example(rng, words)
            if kind is not None:
                spans.append((kind, len(text), len(text) + len(s)))
            text += s + str(rng.choice([" ", ". ", ", ", "\n"]))
        at = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
        out.append((text[at : at + WINDOW], [(k, s - at, e - at) for k, s, e in spans if s >= at and e <= at + WINDOW]))
    return out


@lru_cache(4)
def _trained(words: tuple[str, ...]) -> Tagger:
    data = snippets(list(words), FIT_SNIPPETS)
    rows = np.zeros((len(data), WINDOW), np.int16)
    tags = np.zeros((len(data), WINDOW), np.int64)
    length = np.zeros(len(data), np.int64)
    for r, (text, spans) in enumerate(data):
        s = _symbols(text)
        rows[r, : len(s)], length[r] = s, len(s)
        for k, a, e in spans:
            tags[r, a:e] = 2 + 2 * k
            tags[r, a] = 1 + 2 * k
    return train(rows, length, tags, len(KINDS))


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Tagger:
    """Train on labelled snippets written with the words of at most ``rows`` documents, taken whole (words of 1 to 24 characters)."""
    few = docs.where(F.length("text") > 0).select("doc_id", F.xxhash64("text").alias("h")).orderBy("h", "doc_id").limit(rows)
    got = docs.select("doc_id", "text").join(F.broadcast(few.select("doc_id")), "doc_id", "left_semi")
    head = got.select(F.split("text", r"\s+").alias("w")).select(F.explode("w").alias("w")).where(F.length("w").between(1, 24)).distinct()
    return _trained(tuple(sorted(r["w"] for r in head.collect())) or ("the", "and", "of"))


def _join(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _batched(column: pa.Array) -> Iterator[list[str]]:
    """Texts in lists of about CHUNK_BYTES characters."""
    part, size = [], 0
    for value in column:
        t = value.as_py() or ""
        part.append(t)
        size += len(t)
        if size >= CHUNK_BYTES:
            yield part
            part, size = [], 0
    yield part


def find(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """(doc_id, base_spans, spans): arrays of (kind, start, end) in code points, by kind as listed, then start."""
    span = "array<struct<kind: string, start: long, stop: long>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [x for part in _batched(b.column(1)) for x in tag(part, tagger)]
            cols = [pa.array([[dict(zip(("kind", "start", "stop"), s, strict=True)) for s in x[k]] for x in found], kind) for k in (0, 1)]
            yield pa.record_batch([b.column(0), *cols], names=["doc_id", "base_spans", "spans"])

    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, base_spans {span}, spans {span}")


def op7(docs: DataFrame) -> DataFrame:
    found = find(docs, fit(docs))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    of = lambda k: F.filter("base_spans", lambda s: s["kind"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text("base_spans"), 256).alias("base_sha256"), text("spans").alias("spans"))


def mask(text: str, spans: list[Span]) -> str:
    """The text with each stretch covered by spans replaced by the kind of its first span in brackets."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """The documents with personal data masked; n_chars, where there is one, follows the text."""
    schema = StructType(docs.schema.fields)
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for part in _batched(b.column(at)):
                new += [mask(t, spans) if spans else t for t, (_, spans) in zip(part, tag(part, tagger), strict=True)]
            new = [t if known else None for t, known in zip(new, b.column(at).is_valid().to_pylist(), strict=True)]
            cols = list(b.columns)
            cols[at] = pa.array(new, b.schema.types[at])
            if size is not None:
                cols[size] = pa.array([n if t == o or t is None else len(t) for t, o, n in zip(new, b.column(at).to_pylist(), b.column(size).to_pylist(), strict=True)], b.schema.types[size])
            yield pa.record_batch(cols, names=b.schema.names)

    return docs.mapInArrow(run, schema)
