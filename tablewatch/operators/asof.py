"""Backward, inclusive as-of join: for each left row, the right row of the same key with
the greatest time that is <= the left row's time. No inequality join is used.

Two exact plans:

``method="range"`` (default, skew-proof). Left and right rows are range-partitioned
together on (key, time), so a key holding a third of all rows is spread over many
partitions. A running max inside each (partition, key) finishes the rows; the best right
value of the *earlier* partitions of the same key is carried in from a small table with one
row per (partition, key). The partitioned rows are checkpointed once (eager), because the
range bounds are sampled and both passes must agree on them. Costs a sampling pass, two
shuffles and one write.

``method="bucket"`` (one shuffle) for keys known to be sparse in time:

1. Right rows are aggregated per ``(key, time bucket)`` to their best (time, value): a
   partial aggregate, so a hot key costs one row per map task.
2. A carry per ``(key, bucket)`` holding left rows = best right value of all *earlier*
   buckets: a running ``max`` over the small per-bucket table.
3. Inside each ``(key, bucket)``: left rows, right rows and the carry row are unioned and
   one window keeps the running best right value; right sorts before left on equal times
   (inclusive). The window partition is one key's one bucket, so a key that holds a third
   of the data is still cut into as many partitions as it has buckets.

``bucket`` is a ``date_trunc`` unit; pick it so one key's bucket fits a task
(``day`` for run logs, ``hour`` for dense event streams).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.session import cut_lineage


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    value: str | None = None,
    out: str = "asof_value",
    out_time: str | None = None,
    method: str = "range",
    bucket: str = "day",
    partitions: int | None = None,
) -> DataFrame:
    """``left`` with ``out`` (and ``out_time``) = value (time) of the latest right row of
    the same ``by`` key at or before ``left_on``; NULL when there is none."""
    if method == "bucket":
        return _asof_bucketed(left, right, list(by), left_on, right_on, value, out, out_time, bucket)
    if method != "range":
        raise ValueError("method must be 'range' or 'bucket'")
    return _asof_ranged(left, right, list(by), left_on, right_on, value, out, out_time, partitions)


def _split_valid(left: DataFrame, by: list[str], left_on: str):
    valid = F.col(left_on).isNotNull()
    for k in by:
        valid = valid & F.col(k).isNotNull()
    return left.where(valid), left.where(~valid)


def _fill(lnull: DataFrame, lcols, right: DataFrame, value: str, right_on: str, out: str, out_time: str | None):
    fill = [F.lit(None).cast(right.schema[value].dataType).alias(out)]
    if out_time:
        fill.append(F.lit(None).cast(right.schema[right_on].dataType).alias(out_time))
    return lnull.select(*lcols, *fill)


def _asof_ranged(left, right, by, left_on, right_on, value, out, out_time, partitions):
    value = value or right_on
    lcols = left.columns
    t_type = right.schema[right_on].dataType

    r = right.where(F.col(right_on).isNotNull())
    for k in by:
        r = r.where(F.col(k).isNotNull())
    best = F.struct(F.col(right_on).alias("_t"), F.col(value).alias("_v"))
    lv, lnull = _split_valid(left, by, left_on)
    rrows = r.select(*by, F.col(right_on).alias("_t"), F.lit(0).alias("_side"), best.alias("_rv"))
    best_type = rrows.schema["_rv"].dataType
    lrows = lv.select(*by, F.col(left_on).cast(t_type).alias("_t"), F.lit(1).alias("_side"),
                      F.struct(*[F.col(c) for c in lcols]).alias("_l"))
    l_type = lrows.schema["_l"].dataType
    rows = rrows.withColumn("_l", F.lit(None).cast(l_type)).unionByName(
        lrows.withColumn("_rv", F.lit(None).cast(best_type)))
    # Right sorts before left on equal times (inclusive); equal sort keys never straddle
    # a range boundary. The range bounds come from sampling, so the partitioned rows are
    # materialised once (shared checkpoint folder): the per-partition maxima and the scan
    # must see the same partition ids.
    # Without an explicit count AQE may merge adjacent range partitions (order is kept).
    keys = [*by, "_t", "_side"]
    parted = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    ranged = cut_lineage(parted.withColumn("_pid", F.spark_partition_id()))
    per_part = ranged.groupBy("_pid", *by).agg(F.max("_rv").alias("_pbest"))
    w_carry = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_part.select("_pid", *by, F.max("_pbest").over(w_carry).alias("_carry"))
    w = Window.partitionBy("_pid", *by).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = ranged.withColumn("_m", F.max("_rv").over(w)).where(F.col("_side") == 1)
    j = scanned.join(carry, ["_pid", *by], "left")
    m = F.greatest(F.col("_m"), F.col("_carry"))
    outs = [m["_v"].alias(out)] + ([m["_t"].alias(out_time)] if out_time else [])
    result = j.select(*[F.col(f"_l.{c}").alias(c) for c in lcols], *outs)
    return result.unionByName(_fill(lnull, lcols, right, value, right_on, out, out_time))


def _asof_bucketed(left, right, by, left_on, right_on, value, out, out_time, bucket):
    value = value or right_on
    lcols = left.columns
    t_type = right.schema[right_on].dataType

    r = right.where(F.col(right_on).isNotNull())
    for k in by:
        r = r.where(F.col(k).isNotNull())
    r = r.select(*by, F.col(right_on).alias("_t"), F.col(value).alias("_v")).withColumn(
        "_b", F.date_trunc(bucket, F.col("_t")))
    best = F.struct(F.col("_t"), F.col("_v"))

    lv, lnull = _split_valid(left, by, left_on)
    l = lv.select(*by, F.col(left_on).cast(t_type).alias("_t"), F.struct(*[F.col(c) for c in lcols]).alias("_l")).withColumn(
        "_b", F.date_trunc(bucket, F.col("_t")))

    per_bucket = r.groupBy(*by, "_b").agg(F.max(best).alias("_best"))
    left_buckets = l.select(*by, "_b").distinct()
    best_type = per_bucket.schema["_best"].dataType
    u = left_buckets.select(*by, "_b", F.lit(0).alias("_side"), F.lit(None).cast(best_type).alias("_best")).unionByName(
        per_bucket.select(*by, "_b", F.lit(1).alias("_side"), "_best"))
    w_carry = Window.partitionBy(*by).orderBy("_b", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = u.withColumn("_carry", F.max("_best").over(w_carry)).where(F.col("_side") == 0).where(F.col("_carry").isNotNull())

    l_type = l.schema["_l"].dataType
    rows = (
        carry.select(*by, "_b", F.lit(None).cast(t_type).alias("_t"), F.lit(0).alias("_side"),
                     F.lit(None).cast(l_type).alias("_l"), F.col("_carry").alias("_rv"))
        .unionByName(r.select(*by, "_b", "_t", F.lit(1).alias("_side"), F.lit(None).cast(l_type).alias("_l"),
                              best.alias("_rv")))
        .unionByName(l.select(*by, "_b", "_t", F.lit(2).alias("_side"), "_l", F.lit(None).cast(best_type).alias("_rv")))
    )
    w = Window.partitionBy(*by, "_b").orderBy(F.asc_nulls_first("_t"), "_side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    matched = rows.withColumn("_m", F.max("_rv").over(w)).where(F.col("_side") == 2)
    outs = [F.col("_m._v").alias(out)]
    if out_time:
        outs.append(F.col("_m._t").alias(out_time))
    result = matched.select(*[F.col(f"_l.{c}").alias(c) for c in lcols], *outs)

    return result.unionByName(_fill(lnull, lcols, right, value, right_on, out, out_time))
