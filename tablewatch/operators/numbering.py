"""Numbers 1, 2, ... in order within groups, without a group in one task.

Rows are range-partitioned by group and order together, so a group of any size is spread over many
partitions. A row's number is its place in its partition plus the rows of its group in earlier partitions, which come from a
table with one row per group and partition. The partitioned rows are checkpointed once, because both
passes must see the same sampled range bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewatch.session import cut_lineage


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """``df`` with a long column ``out``; rows equal in ``by`` and ``order`` get their numbers in any order."""
    dealt = cut_lineage(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()))
    place = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*by, "_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*by, "_part")]
    joined = dealt.withColumn("_place", place).alias("r").join(offsets.alias("o"), same)
    return joined.select(*(F.col(f"r.{c}") for c in df.columns), (F.col("_place") + F.col("_before")).cast("long").alias(out))
