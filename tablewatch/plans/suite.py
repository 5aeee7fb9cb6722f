"""Config-driven check suite: every rule of every table in ONE plan and one result frame.

Per table: one aggregate branch (nulls + duplicates) and one branch for all its foreign
keys; drift for all tables from their schemas; freshness for all flagged tables in one
join. The branches are unioned, stamped with one ``run_id`` and one ``checked_at`` and can
be appended with a single write. A missing table, key or FK column yields a fail row
and the suite goes on.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.operators.checks import CHECK_COLUMNS, check_foreign_keys, check_row, table_checks
from tablewatch.operators.drift import check_schema_drift, schema_snapshot
from tablewatch.functions.scalar import utc_now
from tablewatch.operators.freshness import check_freshness, ts_lit
from tablewatch.operators.graph import downstream
from tablewatch.operators.latency import detection_latency
from tablewatch.sources.rules import Rules

RESULT_COLUMNS = ["run_id", "table_name", *CHECK_COLUMNS, "checked_at"]


def _stamp(df: DataFrame, table_name: str | None = None, target=None) -> DataFrame:
    """Check rows of a table; ``target`` is what a foreign key points to, which tells two keys of one column apart."""
    if table_name is not None:
        df = df.withColumn("table_name", F.lit(table_name))
    return df.select("table_name", *CHECK_COLUMNS, (F.lit("") if target is None else target).alias("target"))


def run_suite(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    rules: Rules,
    run_id: int,
    as_of: datetime | str | None = None,
    previous_snapshots: DataFrame | None = None,
    edges: DataFrame | None = None,
    runs: DataFrame | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Results with columns ``RESULT_COLUMNS``; ``with_ids`` adds ``check_result_id``, a hash of the run and of what is
    checked, so the same check of the same run has the same id when a task or the run is repeated."""
    parts: list[DataFrame] = []
    present: dict[str, DataFrame] = {}
    for rule in rules.tables:
        df = tables.get(rule.name)
        if df is None:
            row = check_row("table_exists", None, "fail", None, None, f"table '{rule.name}' not found")
            parts.append(_stamp(spark.range(1).select(F.inline(F.array(row))), rule.name))
            continue
        present[rule.name] = df
        parts.append(_stamp(table_checks(df, rule.null_check_columns, rule.key_columns,
                                         rules.max_null_rate_pct, rules.max_duplicate_rate_pct), rule.name))
        keys, targets = [], []
        for fk in rule.referential_integrity:
            parent = tables.get(fk.parent_table)
            if parent is None:
                row = check_row("referential_integrity", fk.column, "fail", None, None,
                                f"parent table '{fk.parent_table}' not found")
                parts.append(_stamp(spark.range(1).select(F.inline(F.array(row))), rule.name,
                                    F.lit(f"{fk.parent_table}.{fk.parent_column}")))
            else:
                keys.append((fk.column, parent, fk.parent_column))
                targets.append(f"{fk.parent_table}.{fk.parent_column}")
        if keys:
            target = F.array(*map(F.lit, targets))[F.col("fk_no")]
            parts.append(_stamp(check_foreign_keys(df, keys, rules.fail_on_any_orphan, numbered=True), rule.name, target))
    if present:
        snap = schema_snapshot(spark, present).select("table_name", "column_name", "data_type")
        drift = check_schema_drift(snap, previous_snapshots, rules.fail_on_column_removed,
                                   rules.fail_on_type_changed, rules.warn_on_column_added)
        parts.append(_stamp(drift))
    fresh_names = [r.name for r in rules.tables if r.freshness_check and r.name in present]
    if fresh_names:
        names = spark.createDataFrame([(n,) for n in fresh_names], "table_name string")
        if edges is None:
            edges = spark.createDataFrame([], "job_name string, target_table string, detected_at timestamp_ntz")
        if runs is None:
            runs = spark.createDataFrame([], "job_name string, status string, finished_at timestamp_ntz")
        parts.append(_stamp(check_freshness(names, edges, runs, rules.max_staleness_hours, as_of)))
    out = reduce(DataFrame.unionByName, parts)
    checked = utc_now() if as_of is None else ts_lit(as_of)
    run = F.lit(run_id).cast("long")
    ids = [F.xxhash64(run, "table_name", "check_type", F.coalesce("column_name", F.lit("")), "target").alias("check_result_id")]
    return out.select(run.alias("run_id"), "table_name", *CHECK_COLUMNS, checked.alias("checked_at"), *(ids if with_ids else []))


def iter_suite(spark: SparkSession, tables: dict[str, DataFrame], rules: Rules, run_id: int, tables_per_plan: int = 50,
               **kw):
    """``run_suite`` in batches of ``tables_per_plan`` rules: for configurations with very
    many tables, each batch is one plan (bounded analysis time) appended on its own."""
    items = list(rules.tables)
    for i in range(0, len(items), tables_per_plan):
        yield run_suite(spark, tables, replace(rules, tables=tuple(items[i:i + tables_per_plan])), run_id, **kw)


def suite_failures(results: DataFrame, edges: DataFrame, runs: DataFrame) -> DataFrame:
    """The failing rows of a run with what an alert needs: how many tables lie downstream of the failing one, and how
    long after its last successful write the failure was found (as of the check). ``edges``: source_table,
    target_table, job_name, detected_at."""
    fails = results.where(F.col("status") == "fail")
    reach = downstream(edges, fails.select("table_name").distinct()).groupBy("table_name").agg(F.count("*").alias("affected_count"))
    found = detection_latency(fails.join(reach, "table_name", "left"), edges, runs)
    return found.select(*results.columns, F.coalesce("affected_count", F.lit(0)).cast("long").alias("affected_count"),
                        "job_name", "last_written_at", "latency_seconds", "latency_human")


def suite_totals(results: DataFrame) -> DataFrame:
    """Per run: checks run / failed / warned; the suite's own run-log counts (rows read =
    rows written = checks run)."""
    n = F.count(F.lit(1))
    return results.groupBy("run_id").agg(
        n.alias("checks_run"),
        F.count_if(F.col("status") == "fail").alias("checks_failed"),
        F.count_if(F.col("status") == "warn").alias("checks_warned"),
    ).select("run_id", "checks_run", "checks_failed", "checks_warned",
             F.col("checks_run").alias("rows_read"), F.col("checks_run").alias("rows_written"))
