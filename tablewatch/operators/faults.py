"""Fault transforms (DataFrame -> DataFrame) used to prove the checks catch failures."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_column(df: DataFrame, column: str) -> DataFrame:
    """Schema-drift fault: the column disappears."""
    return df.drop(column)


def null_out(df: DataFrame, column: str, condition: Column) -> DataFrame:
    """Null-rate fault: ``column`` becomes NULL where ``condition`` holds."""
    return df.withColumn(column, F.when(condition, F.lit(None)).otherwise(F.col(column)))


def break_foreign_key(
    df: DataFrame, key_columns: Sequence[str], fk_column: str, n: int = 50, prefix: str = "INVALID_"
) -> DataFrame:
    """Referential fault: the ``n`` rows with the smallest keys get unique fake FK values
    ``prefix || 1..n``; every other row is untouched and the row count is preserved.

    The sample is a top-n by key (partial top-n per task, then merge); one left join marks
    its rows, and the planner decides how to join it. ``df`` is expected to be unique on ``key_columns`` (dedupe first otherwise).
    """
    keys = list(key_columns)
    # top-n by key (partial top-n per task, then merge), numbered while it is n rows
    sample = df.select(*keys).orderBy(*keys).limit(n)
    sample = sample.withColumn("_tw_n", F.row_number().over(Window.orderBy(*keys)))
    fake = F.concat(F.lit(prefix), F.col("_tw_n").cast("string"))
    marked = df.join(sample, keys, "left")
    return marked.withColumn(fk_column, F.coalesce(fake, F.col(fk_column).cast("string"))).select(*df.columns)


def stale_as_of(as_of: datetime, hours: float = 30) -> datetime:
    """Staleness fault without rewriting data: evaluate freshness ``hours`` later."""
    return as_of + timedelta(hours=hours)
