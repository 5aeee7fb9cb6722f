"""Latest-row-per-key and deterministic dedupe (window ``row_number``/``rank`` = 1).

Spark plans a *partial* ``WindowGroupLimit`` before the shuffle for these filters, so each
map task forwards at most one row (or the tied rows) per key: a key that holds a third
of all rows costs one row per task in the exchange, not a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], ties: bool = False) -> DataFrame:
    """Rows ranked first per key under ``order_by``; ``ties=True`` keeps every tied row (rank)."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    rank = F.rank() if ties else F.row_number()
    return df.withColumn("_tw_rank", rank.over(w)).where(F.col("_tw_rank") == 1).drop("_tw_rank")


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None) -> DataFrame:
    """``dropDuplicates(keys)`` with a deterministic survivor.

    Without ``order_by`` the survivor is the least row under a total order on the
    remaining columns (ascending, NULLs first), so reruns pick the same row.
    """
    if order_by is None:
        order_by = [F.asc_nulls_first(c) for c in df.columns if c not in keys]
        if not order_by:
            return df.dropDuplicates(list(keys))
    return latest_per_key(df, keys, order_by, ties=False)
