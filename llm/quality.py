"""Quality classifier by compression (operator 4).

Two zstandard dictionaries are trained, one from good and one from bad labelled texts. Text
that resembles one side compresses better with its dictionary, so the difference of the two
compressed sizes, divided by the plain compressed size, tells the sides apart; a logistic fit
on other labelled texts turns it into a probability.

Defined results: null and empty texts get the share of good labels; so does every text when no
label, or only one kind of label, can be learned from (0.5 without any label). Rows whose label
or id is null are not learned from; a document labelled twice counts with its smallest label.
Repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Labelled rows of each class to fit on, at most (the rows of least hash); half train the
#: dictionaries, half the calibration.
FIT_ROWS = 1200
DICTIONARY_BYTES = 64 << 10
PIECE = 1024
LEVEL = 3
THRESHOLD = 0.3


def train_dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of the texts' frequent strings; raw text where they are too few to train."""
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)  # too few strings to choose from: all of them


class Sizes:
    """Compressed sizes of a text: with the good dictionary, with the bad one, and with none."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.tools = []
        for d in (good, bad, b""):
            data = zstandard.ZstdCompressionDict(d) if d else None
            if data:
                data.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False))

    def __call__(self, text: bytes) -> tuple[int, ...]:
        return tuple(len(t.compress(text)) for t in self.tools)


def features(sizes: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Constant, normalised difference of the dictionary sizes, how far the text compresses at all, and products."""
    good, bad, plain = sizes.T.astype(float)
    diff = (bad - good) / np.maximum(plain, 1)
    left = np.log(np.maximum(np.minimum(good, bad), 1) / np.maximum(length, 1))
    return np.stack([np.ones(len(diff)), diff, left, diff * left, diff * diff, left * left], 1)


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    prior: float

    def scores(self, texts: list[bytes], tool: Sizes | None = None) -> np.ndarray:
        if not len(self.weights) or not texts:
            return np.full(len(texts), self.prior)
        tool = tool or Sizes(self.good, self.bad)
        length = np.array([len(t) for t in texts])
        x = (features(np.array([tool(t) for t in texts]), length) - self.centre) / self.scale
        return np.where(length > 0, 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))), self.prior)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_texts(good: list[bytes], bad: list[bytes], n_good: float, n_bad: float) -> Model:
    prior = n_good / (n_good + n_bad) if n_good + n_bad else 0.5
    if len(good) < 4 or len(bad) < 4:
        return Model(b"", b"", np.zeros(0), np.zeros(0), np.ones(0), prior)
    model = Model(train_dictionary(good[::2]), train_dictionary(bad[::2]), np.zeros(0), np.zeros(0), np.ones(0), prior)
    tool = Sizes(model.good, model.bad)
    texts = good[1::2] + bad[1::2]
    y = np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
    x = features(np.array([tool(t) for t in texts]), np.array([len(t) for t in texts]))
    model.centre, model.scale = np.r_[0, x[:, 1:].mean(0)], np.r_[1, x[:, 1:].std(0) + 1e-9]
    share = np.where(y > 0, n_good / max(1, (y > 0).sum()), n_bad / max(1, (y == 0).sum()))
    model.weights = logistic((x - model.centre) / model.scale, y, share / share.sum() * len(y))
    return model


def held_out(key: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text, modulo 5, is 0; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents of each class; only these come to the driver."""
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min(label).alias("y"))
    usable = usable.join(docs.where(F.length("text") > 0).select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = [usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * rows ids at most
    got = docs.select("doc_id", "text").join(chosen, "doc_id").where(F.length("text") > 0).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("text").alias("text")).collect()
    got = sorted((r["doc_id"], r["y"], r["text"].encode()) for r in got)
    return fit_texts([t for _, y, t in got if y == 1], [t for _, y, t in got if y == 0], counts.get(1, 0), counts.get(0, 0))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "quality_score") -> DataFrame:
    """The input rows with the score appended as ``out`` (an older column of that name is replaced)."""
    docs = docs.drop(out)
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Sizes(model.good, model.bad)
        for b in (whole.slice(i, 256) for whole in batches for i in range(0, max(1, whole.num_rows), 256)):
            texts = [t or b"" for t in b.column(at).cast(pa.large_binary() if pa.types.is_large_string(b.column(at).type) else pa.binary()).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(model.scores(texts, tool), pa.float64())], names=[*b.schema.names, out])

    return docs.mapInArrow(run, schema)


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their columns unchanged."""
    own = "quality_score"
    while own in docs.columns:  # a column of the table's own stays
        own += "_"
    return score(docs, fit(docs, labels), out=own).where(F.col(own) >= threshold).drop(own)
