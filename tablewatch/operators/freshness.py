"""Producing job of a table, last successful write, freshness check."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.messages import FRESHNESS_DETAIL, NO_WRITE_DETAIL, render
from tablewatch.functions.scalar import fixed, iso_text, py_num, seconds_between, utc_now
from tablewatch.operators.latest import latest_per_key


def ts_lit(value: datetime | str | Column) -> Column:
    """A timestamp_ntz literal (the driver data and metadata are NTZ)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def producing_job(edges: DataFrame) -> DataFrame:
    """``(table_name, job_name)``: the job of the newest edge into each target table
    (ties on ``detected_at`` resolved by job name)."""
    latest = latest_per_key(
        edges.select("target_table", "job_name", "detected_at"),
        ["target_table"],
        [F.desc_nulls_last("detected_at"), F.asc("job_name")],
    )
    return latest.select(F.col("target_table").alias("table_name"), "job_name")


def last_successful_write(runs: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    """``(job_name, last_written_at)``: newest ``finished_at`` of a successful run per job,
    among those finished by ``as_of`` (default: all)."""
    known = F.col("finished_at").isNotNull() if as_of is None else F.col("finished_at") <= ts_lit(as_of)
    return (
        runs.where((F.col("status") == "success") & known)
        .groupBy("job_name")
        .agg(F.max("finished_at").alias("last_written_at"))
    )


def check_freshness(
    tables: DataFrame,
    edges: DataFrame,
    runs: DataFrame,
    max_staleness_hours: float = 24,
    as_of: datetime | str | Column | None = None,
) -> DataFrame:
    """Hours since the last successful write of each table's producing job; fail iff above
    the threshold, or when no write is on record. All tables in one plan."""
    now = utc_now() if as_of is None else ts_lit(as_of)
    j = (
        tables.select("table_name")
        .join(producing_job(edges), "table_name", "left")
        .join(last_successful_write(runs, as_of), "job_name", "left")
    )
    last = F.col("last_written_at")
    hours = seconds_between(last, now) / F.lit(3600.0)
    status = F.when(last.isNull(), F.lit("fail")).when(hours > F.lit(float(max_staleness_hours)), F.lit("fail")).otherwise(F.lit("pass"))
    detail = F.when(last.isNull(), F.lit(NO_WRITE_DETAIL)).otherwise(
        render(FRESHNESS_DETAIL, last=iso_text(last), hours=fixed(hours, 2), threshold=py_num(max_staleness_hours)))
    return j.select(
        "table_name",
        "job_name",
        "last_written_at",
        F.lit("freshness").alias("check_type"),
        F.lit(None).cast("string").alias("column_name"),
        status.alias("status"),
        hours.alias("measured"),
        F.lit(float(max_staleness_hours)).alias("threshold"),
        detail.alias("detail"),
    )
