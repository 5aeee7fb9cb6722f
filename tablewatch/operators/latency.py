"""Detection latency: time from the last successful write of a table (by its producing
job) to the check that caught the failure, with a human-readable rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.messages import UNKNOWN_LATENCY
from tablewatch.functions.scalar import humanize_seconds, seconds_between
from tablewatch.operators.asof import asof_backward
from tablewatch.operators.freshness import producing_job


def detection_latency(checks: DataFrame, edges: DataFrame, runs: DataFrame, method: str = "range",
                      bucket: str = "day") -> DataFrame:
    """For every row of ``checks`` (needs ``table_name``, ``checked_at``): producing job,
    ``last_written_at`` = newest successful ``finished_at <= checked_at`` of that job,
    ``latency_seconds`` and ``latency_human``."""
    with_job = checks.join(producing_job(edges), "table_name", "left")
    writes = runs.where((F.col("status") == "success") & F.col("finished_at").isNotNull()).select("job_name", "finished_at")
    a = asof_backward(with_job, writes, ["job_name"], "checked_at", "finished_at", out="last_written_at", method=method, bucket=bucket)
    secs = seconds_between(F.col("last_written_at"), F.col("checked_at"))
    return a.select(
        *checks.columns,
        "job_name",
        "last_written_at",
        secs.alias("latency_seconds"),
        F.coalesce(humanize_seconds(secs), F.lit(UNKNOWN_LATENCY)).alias("latency_human"),
    )
