"""Vectorised text helpers shared by the operators: a batch of texts is one byte buffer.

A batch is a list of Python/Arrow strings laid end to end as UTF-8 in one ``uint8`` array with
document offsets. Word bounds, rolling hashes and sliding minima are then whole-array numpy
operations; nothing loops over characters or words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; a longer single text is a chunk of its own.
CHUNK_BYTES = 1 << 19

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


class Roller:
    """Hashes of any stretch of a sequence of 64-bit values, by prefix sums of value * B**i.

    ``(S[e] - S[s]) * B**-s`` depends only on the values in ``[s, e)``; B is odd, so its powers
    are invertible modulo 2**64.
    """

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 62, 1 << 63)) * 8 + 5 & (1 << 64) - 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
        self._up = self._down = np.ones(1, U64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = 1 << (n - 1).bit_length()
            for name, b in (("_up", self.base), ("_down", self.inverse)):
                p = np.ones(size, U64)
                filled = 1
                while filled < size:  # doubling: p[filled:2*filled] = p[:filled] * b**filled
                    p[filled : 2 * filled] = p[:filled] * U64(pow(b, filled, 1 << 64))
                    filled *= 2
                setattr(self, name, p)
        return self._up, self._down

    def prefix(self, values: np.ndarray) -> np.ndarray:
        up, _ = self._powers(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[: len(values)], out=out[1:])
        return out

    def stretch(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, down = self._powers(len(prefix))
        # the length keeps stretches of different lengths apart
        return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64) * U64(0x9E3779B97F4A7C15))

    def runs(self, prefix: np.ndarray, n: int) -> np.ndarray:
        """Hashes of every run of n consecutive values."""
        m = len(prefix) - n
        if m <= 0:
            return np.zeros(0, U64)
        _, down = self._powers(len(prefix))
        return mix((prefix[n:] - prefix[:m]) * down[:m] + U64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


BYTES, WORDS = Roller(11), Roller(12)


def chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for stretches of rows of about ``limit`` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else pa.binary())
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the first word of each text (n + 1)."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True  # texts end words
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return BYTES.stretch(BYTES.prefix(BYTES.table[data]), starts, ends)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    if len(x) < w:
        return x[:0]
    have, out = 1, x
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def inside(first: np.ndarray, n: int, length: int) -> np.ndarray:
    """For runs of ``length`` over n units whose texts start at ``first`` (n_texts + 1): those in one text."""
    m = max(0, n - length + 1)
    ok = np.ones(m, bool)
    if m:
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        ok = text[:m] == text[length - 1 :]
    return ok


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
