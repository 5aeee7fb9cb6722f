"""A Bloom filter of fixed size over 64-bit keys: a prefilter for joins, never a decision.

The bits are set by Spark (one row for each 64 bits, so the driver receives ``bits / 64`` numbers at most
however many keys there are). With more keys the filter lets more rows through and the join
behind it still gives the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.textnum import U64, mix


def places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three bits for each key; ``bits`` is a power of two, 2**26 at most."""
    h = mix(keys.view(U64) + U64(0x632BE59BD9B4E019))
    return [(h >> U64(shift)) & U64(bits - 1) for shift in (0, 19, 38)]


def build(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """The filter of a column of longs; nulls set nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.column(0).drop_null().to_numpy(zero_copy_only=False)
            at = np.unique(np.concatenate(places(k, bits)))
            slot, first = np.unique(at >> U64(6), return_index=True)
            mask = np.bitwise_or.reduceat(U64(1) << (at & U64(63)), first) if len(slot) else slot
            yield pa.record_batch([pa.array(slot.astype(np.int64)), pa.array(mask.view(np.int64))], names=["slot", "mask"])

    rows = keys.select(column).mapInArrow(run, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask"))
    found = rows.toArrow()
    out = np.zeros(max(1, bits >> 6), U64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().view(U64)
    return out


def maybe(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter; all that are in it are among them."""
    ok = np.ones(len(keys), bool)
    for at in places(keys, len(filter_) << 6):
        ok &= (filter_[at >> U64(6)] >> (at & U64(63)) & U64(1)).astype(bool)
    return ok
