"""Command line: run the check suite, build lineage, inspect tables, compute blast radius.

    python -m tablewatch suite --rules rules.yaml --results dq_check_results \\
        [--runs pipeline_run_events] [--edges lineage_edges] [--failures dq_failures] [--as-of "2024-01-31 00:00:00"]
    python -m tablewatch lineage --scripts jobs/ --edges lineage_edges   (or --config config.yaml)
    python -m tablewatch init [--prefix meta.]
    python -m tablewatch load customers --source data/customers.csv --target stg_customers --runs pipeline_run_events
    python -m tablewatch build-warehouse --runs pipeline_run_events
    python -m tablewatch inventory stg_orders Fact_Order_Items
    python -m tablewatch blast-radius --edges lineage_edges stg_orders

Tables are catalog tables of the active session (``spark.read.table``). Results are
stored once a run (partitioned by check day and run), edges are upserted and swapped in as a new version, and
with ``--runs`` the suite logs itself as ``dq_check_run``. Output is printed as JSON lines.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, name: str | None) -> DataFrame | None:
    if name and spark.catalog.tableExists(name):
        return spark.read.table(name)
    return None


def _edges(spark: SparkSession, edges: str | None, overrides: str | None) -> DataFrame | None:
    """Auto-parsed edges combined with manual overrides (override wins per table pair)."""
    from tablewatch.operators.edges import combine_edges

    auto, manual = _table(spark, edges), _table(spark, overrides)
    if auto is None and manual is None:
        return None
    if auto is None:
        auto, manual = manual, None
    return combine_edges(auto, manual)


def _events(spark: SparkSession, runs: str | None) -> DataFrame | None:
    """The run events of a catalog table, or of a folder (a name with a slash)."""
    from tablewatch.operators.runlog import read_events

    return read_events(spark, runs) if runs and "/" in runs else _table(spark, runs)


def _print(df: DataFrame) -> None:
    for row in df.toLocalIterator():  # report-sized outputs only
        print(json.dumps(row.asDict(recursive=True), default=str))


def cmd_suite(spark: SparkSession, a: argparse.Namespace) -> None:
    from tablewatch.operators.digest import digest_lines
    from tablewatch.operators.graph import downstream
    from tablewatch.operators.drift import last_snapshot, latest_snapshot, schema_snapshot, stamp_snapshot
    from tablewatch.functions.scalar import utc_now
    from tablewatch.operators.freshness import ts_lit
    from tablewatch.operators.runlog import RunLog, current_runs, new_run_id
    from tablewatch.plans.suite import run_suite, suite_failures, suite_totals
    from tablewatch.sources.catalog import append_results_table
    from tablewatch.sources.rules import load_rules

    rules = load_rules(a.rules)
    names = {r.name for r in rules.tables} | {fk.parent_table for r in rules.tables for fk in r.referential_integrity}
    tables = {n: _table(spark, n) for n in names}
    tables = {n: df for n, df in tables.items() if df is not None}
    history = _table(spark, a.results)
    snapshots = _table(spark, a.snapshots)
    if snapshots is not None:
        previous = latest_snapshot(snapshots)
    else:
        previous = last_snapshot(history, a.baseline) if history is not None else None
    edges = _edges(spark, a.edges, a.overrides)
    log = RunLog(spark, a.runs, "dq_check_run") if a.runs else None
    run_id = log.start(a.run_id) if log else a.run_id if a.run_id is not None else new_run_id()
    try:
        events = _events(spark, a.runs)  # listed after the start event, which replaces that of a run that is repeated
        runs = current_runs(events) if events is not None else None
        res = run_suite(spark, tables, rules, run_id, a.as_of, previous, edges, runs, with_ids=True)
        append_results_table(spark, res.withColumn("check_date", F.to_date("checked_at")), a.results)
        if a.snapshots:
            present = {r.name: tables[r.name] for r in rules.tables if r.name in tables}
            now = ts_lit(a.as_of) if a.as_of else utc_now()
            stamp_snapshot(schema_snapshot(spark, present), run_id, now).write.mode("append").saveAsTable(a.snapshots)
        stored = spark.read.table(a.results).where(F.col("run_id") == run_id)
        totals = suite_totals(stored)
        n = totals.first()["checks_run"]
        if edges is not None and runs is not None:
            failures = suite_failures(stored.drop("check_date"), edges, runs).select(
                "table_name", "check_type", "column_name", "detail", "affected_count", "latency_human")
            if a.failures:
                failures.withColumn("run_id", F.lit(run_id).cast("long")).write.mode("append").saveAsTable(a.failures)
            _print(failures.orderBy("table_name", "check_type", "column_name"))
            if a.digest:
                failed = stored.where("status = 'fail'").select("table_name").distinct()
                radius = downstream(edges, failed).select(F.col("table_name").alias("failing_table"), F.col("downstream_table").alias("affected_table"))
                digest_lines(stored, radius, a.as_of).write.mode("append").saveAsTable(a.digest)
    except BaseException as problem:
        if log:
            log.finish("failed", error_message=str(problem) or type(problem).__name__)
        raise
    if log:
        log.finish("success", n, n)
    _print(totals)


def cmd_lineage(spark: SparkSession, a: argparse.Namespace) -> None:
    from tablewatch.operators.edges import upsert_edges
    from tablewatch.operators.extract import extract_lineage, lineage_edges, unresolved_cases
    from tablewatch.sources.versioned import replace_table
    from tablewatch.session import cut_lineage
    from tablewatch.sources.files import read_scripts

    if a.config:
        from tablewatch.sources.files import read_job_scripts
        import yaml

        with open(a.config, encoding="utf-8") as fh:
            jobs = {j["name"]: j["script_path"] for j in yaml.safe_load(fh).get("pipeline_jobs", [])}
        corpus = read_job_scripts(spark, jobs)
    else:
        corpus = read_scripts(spark, a.scripts)
    ex = cut_lineage(extract_lineage(corpus))
    new = lineage_edges(ex)
    old = _table(spark, a.edges)
    if old is None:
        new.write.saveAsTable(a.edges)
    else:
        replace_table(spark, upsert_edges(old, new), a.edges)
    unresolved = unresolved_cases(ex)
    if a.unresolved:
        unresolved.write.mode("overwrite").saveAsTable(a.unresolved)
    _print(unresolved)


def cmd_inventory(spark: SparkSession, a: argparse.Namespace) -> None:
    from tablewatch.sources.catalog import table_inventory

    names = a.tables or [t.name for t in spark.catalog.listTables() if not t.isTemporary]
    _print(table_inventory(spark, names))


def cmd_blast(spark: SparkSession, a: argparse.Namespace) -> None:
    from tablewatch.operators.graph import blast_radius

    failing = spark.createDataFrame([(t,) for t in a.tables], "table_name string")
    edges = _edges(spark, a.edges, a.overrides)
    _print(blast_radius(edges, failing).drop("path").orderBy("failing_table", "affected_table"))


def _logged(spark: SparkSession, runs: str | None, job: str):
    from contextlib import nullcontext

    from tablewatch.operators.runlog import RunLog

    return RunLog(spark, runs, job).run() if runs else nullcontext(None)


def cmd_load(spark: SparkSession, a: argparse.Namespace) -> None:
    from tablewatch.plans.staging import RAW_SCHEMAS, STAGERS
    from tablewatch.sources.files import read_csv

    with _logged(spark, a.runs, f"load_{a.entity}") as run:
        raw = read_csv(spark, a.source, RAW_SCHEMAS[a.entity])
        raw = run.observe_read(raw) if run else raw
        out = STAGERS[a.entity](raw)
        out = run.observe_write(out) if run else out
        out.write.mode("overwrite").saveAsTable(a.target)
    print(json.dumps({"loaded": a.target}))


def cmd_build_warehouse(spark: SparkSession, a: argparse.Namespace) -> None:
    from tablewatch.plans.warehouse import build_warehouse

    names = ["stg_customers", "stg_orders", "stg_order_items", "stg_products", "stg_sellers"]
    with _logged(spark, a.runs, "build_warehouse") as run:
        stg = {n: spark.read.table(n) for n in names}
        tables = build_warehouse(stg, lambda name, df: df.write.mode("overwrite").saveAsTable(name), run)
    print(json.dumps({"built": sorted(tables)}))


def cmd_init(spark: SparkSession, a: argparse.Namespace) -> None:
    from tablewatch.sources.metadata import create_metadata_tables

    for name in create_metadata_tables(spark, a.prefix):
        print(json.dumps({"created": name}))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="tablewatch")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("suite")
    s.add_argument("--rules", required=True)
    s.add_argument("--results", required=True)
    s.add_argument("--runs")
    s.add_argument("--edges")
    s.add_argument("--overrides", help="manual edge table, combined with --edges (override wins)")
    s.add_argument("--as-of")
    s.add_argument("--run-id", type=int)
    s.add_argument("--baseline", choices=["latest", "last_pass"], default="latest")
    s.add_argument("--snapshots", help="typed schema snapshot table: read as baseline, appended per run")
    s.add_argument("--failures", help="table to append the failing checks with blast radius and latency to")
    s.add_argument("--digest", help="table to append the lines of the alert to")
    s.set_defaults(fn=cmd_suite)
    li = sub.add_parser("lineage")
    src = li.add_mutually_exclusive_group(required=True)
    src.add_argument("--scripts", help="directory of job scripts (job name = file name)")
    src.add_argument("--config", help="YAML with pipeline_jobs: [{name, script_path}]")
    li.add_argument("--edges", required=True)
    li.add_argument("--unresolved", help="table to overwrite with the unresolved cases")
    li.set_defaults(fn=cmd_lineage)
    inv = sub.add_parser("inventory")
    inv.add_argument("tables", nargs="*", help="default: every table of the current database")
    inv.set_defaults(fn=cmd_inventory)
    ld = sub.add_parser("load")
    ld.add_argument("entity", choices=["customers", "orders", "order_items", "products", "sellers"])
    ld.add_argument("--source", required=True, help="headered CSV file or folder")
    ld.add_argument("--target", required=True)
    ld.add_argument("--runs", help="run event table (or Parquet folder) to log to")
    ld.set_defaults(fn=cmd_load)
    bw = sub.add_parser("build-warehouse")
    bw.add_argument("--runs")
    bw.set_defaults(fn=cmd_build_warehouse)
    ini = sub.add_parser("init")
    ini.add_argument("--prefix", default="")
    ini.set_defaults(fn=cmd_init)
    b = sub.add_parser("blast-radius")
    b.add_argument("--edges", required=True)
    b.add_argument("--overrides")
    b.add_argument("tables", nargs="+")
    b.set_defaults(fn=cmd_blast)
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tablewatch-{a.cmd}").getOrCreate()
    a.fn(spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
