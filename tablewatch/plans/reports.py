"""Report views over the results, runs and edge tables.

"Latest" follows the check-history convention: the newest ``checked_at`` per
``(table_name, check_type)`` with ties kept (several column checks of one run share it).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.scalar import SEVERITY, STATUS_MARKER, severity, utc_now
from tablewatch.operators.freshness import ts_lit
from tablewatch.operators.graph import blast_radius, blast_radius_summary, downstream, nodes_of, upstream
from tablewatch.operators.latest import latest_per_key

STATUSES = ("pass", "warn", "fail")
LATEST_KEYS = ("table_name", "check_type")
RESULT_VIEW = ("table_name", "check_type", "column_name", "status", "detail", "checked_at")


def latest_results(results: DataFrame, keys: Sequence[str] = LATEST_KEYS) -> DataFrame:
    return latest_per_key(results, list(keys), [F.desc("checked_at")], ties=True)


def all_latest_results(results: DataFrame) -> DataFrame:
    return latest_results(results).select(*RESULT_VIEW).orderBy("table_name", "check_type")


def status_per_table(results: DataFrame) -> DataFrame:
    """Worst latest status per table (fail > warn > pass)."""
    order = F.array(*[F.lit(s) for s in sorted(SEVERITY, key=SEVERITY.get)])
    g = latest_results(results).groupBy("table_name").agg(F.max(severity(F.col("status"))).alias("sev"))
    return g.select("table_name", F.element_at(order, F.col("sev") + 1).alias("status"))


def dq_summary(results: DataFrame) -> DataFrame:
    """``(status, check_count)`` over the latest results, zero rows kept for each status."""
    latest = latest_results(results)
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    g = latest.agg(*counts)
    return g.select(F.inline(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("check_count")) for s in STATUSES])))


def dq_history(results: DataFrame, days: int = 7, as_of: datetime | str | Column | None = None,
               partition_col: str = "check_date") -> DataFrame:
    """Daily counts per status over the last ``days`` days. On a results table partitioned
    by check day the window is also stated on the partition column, so whole days outside
    it are pruned at the scan."""
    now = utc_now() if as_of is None else ts_lit(as_of)
    since = now - F.make_dt_interval(F.lit(days))
    recent = results.where(F.col("checked_at") >= since)
    if partition_col in results.columns:
        recent = recent.where(F.col(partition_col) >= F.to_date(since))
    return (
        recent.groupBy(F.to_date("checked_at").alias("check_date"), "status")
        .agg(F.count(F.lit(1)).alias("check_count"))
        .orderBy("check_date", "status")
    )


def dq_history_pivot(history: DataFrame) -> DataFrame:
    """Days x statuses with zeros for absent cells (statuses listed, so no extra job)."""
    p = history.groupBy("check_date").pivot("status", list(STATUSES)).agg(F.sum("check_count"))
    return p.select("check_date", *[F.coalesce(F.col(s), F.lit(0)).cast("long").alias(s) for s in STATUSES]).orderBy("check_date")


def recent_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    cols = ["run_id", "job_name", "started_at", "finished_at", "status", "rows_read", "rows_written", "duration_seconds"]
    return runs.select(*cols).orderBy(F.desc_nulls_last("started_at"), F.desc("run_id")).limit(limit)


def results_filtered(results: DataFrame, statuses: Sequence[str] | None = None,
                     tables: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Latest results narrowed to statuses and tables, with a display marker."""
    latest = latest_results(results)
    if statuses is not None:
        latest = latest.where(F.col("status").isin(list(statuses)))
    if isinstance(tables, DataFrame):
        latest = latest.join(tables.select("table_name").distinct(), "table_name", "left_semi")
    elif tables is not None:
        latest = latest.where(F.col("table_name").isin(list(tables)))
    marker = F.create_map(*[x for k, v in STATUS_MARKER.items() for x in (F.lit(k), F.lit(v))])
    return latest.select(*RESULT_VIEW, marker[F.col("status")].alias("marker"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def overview_metrics(edges: DataFrame, results: DataFrame) -> DataFrame:
    """``(metric, value)``: tables tracked, lineage edges, checks passing, checks failing."""
    nodes = nodes_of(edges).agg(F.count(F.lit(1)).alias("value")).select(F.lit("tables_tracked").alias("metric"), "value")
    pairs = edges.select("source_table", "target_table").distinct().agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("lineage_edges").alias("metric"), "value")
    s = latest_results(results).agg(F.count_if(F.col("status") == "pass").alias("p"),
                                    F.count_if(F.col("status") == "fail").alias("f"))
    checks = s.select(F.inline(F.array(F.struct(F.lit("checks_passing").alias("metric"), F.col("p").alias("value")),
                                       F.struct(F.lit("checks_failing").alias("metric"), F.col("f").alias("value")))))
    return nodes.unionByName(pairs).unionByName(checks)


def node_status(edges: DataFrame, results: DataFrame) -> DataFrame:
    """Every lineage node with its worst latest status, ``not checked`` when none."""
    return nodes_of(edges).join(status_per_table(results), "table_name", "left").select(
        "table_name", F.coalesce(F.col("status"), F.lit("not checked")).alias("status"))


def table_drilldown(edges: DataFrame, results: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Per table of ``tables`` (column ``table_name``; default: every node of the graph): number of upstream and
    downstream tables, latest status, alert flag."""
    starts = nodes_of(edges) if tables is None else tables.select("table_name").distinct()
    down = downstream(edges, starts)
    # From every node, the pairs are the same either way.
    up = upstream(edges, starts, down=down if tables is None else None)
    n_up = up.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_upstream"))
    n_down = down.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_downstream"))
    st = status_per_table(results)
    j = starts.join(n_up, "table_name", "left").join(n_down, "table_name", "left").join(st, "table_name", "left")
    return j.select(
        "table_name",
        F.coalesce("n_upstream", F.lit(0)).cast("long").alias("n_upstream"),
        F.coalesce("n_downstream", F.lit(0)).cast("long").alias("n_downstream"),
        F.coalesce(F.col("status"), F.lit("not checked")).alias("status"),
        F.coalesce(F.col("status") == "fail", F.lit(False)).alias("alert"),
    )


def report_lines(results: DataFrame) -> DataFrame:
    """One console line per result: marker, check type, ``[column]`` label and the first
    80 characters of the detail, e.g. ``FAIL null_check             [c] null_rate=...``."""
    marker = F.create_map(*[x for k, v in STATUS_MARKER.items() for x in (F.lit(k), F.lit(v))])[F.col("status")]
    label = F.when(F.col("column_name").isNotNull() & (F.col("column_name") != ""),
                   F.concat(F.lit("["), F.col("column_name"), F.lit("] "))).otherwise(F.lit(""))
    line = F.concat(F.rpad(marker, 4, " "), F.lit(" "), F.rpad(F.col("check_type"), 22, " "), F.lit(" "), label,
                    F.left(F.coalesce(F.col("detail"), F.lit("")), F.lit(80)))
    return results.select("run_id", "table_name", "check_type", "column_name", "status", line.alias("line"))


def failing_latest(results: DataFrame) -> DataFrame:
    return latest_results(results).where(F.col("status") == "fail")


def failing_with_blast_radius(edges: DataFrame, results: DataFrame) -> DataFrame:
    """Currently failing checks with the number of downstream tables at risk."""
    fails = failing_latest(results).select(*RESULT_VIEW)
    # counts only: plain reachability, no path bookkeeping
    reach = downstream(edges, fails.select("table_name").distinct()).select(
        F.col("table_name").alias("failing_table"), F.col("downstream_table").alias("affected_table"))
    summary = blast_radius_summary(fails.select("table_name"), reach)
    return fails.join(summary.withColumnRenamed("failing_table", "table_name"), "table_name", "left").select(
        *RESULT_VIEW, F.coalesce("affected_count", F.lit(0)).cast("long").alias("affected_count"))


def failure_drilldown(edges: DataFrame, results: DataFrame) -> DataFrame:
    """Failing check x affected table x path text (one row with NULLs when contained)."""
    fails = failing_latest(results).select("table_name", "check_type", "column_name")
    radius = blast_radius(edges, fails.select("table_name").distinct())
    return fails.join(radius.withColumnRenamed("failing_table", "table_name"), "table_name", "left").select(
        "table_name", "check_type", "column_name", "affected_table", "distance", "path_text")
