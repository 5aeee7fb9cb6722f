"""Schema snapshots and schema drift.

Snapshots are long-form rows ``(table_name, column_name, data_type)``; drift is one full
outer join of the current and the previous snapshot on ``(table_name, column_name)``,
then one conditional aggregation per table. Type names are ``DataType.simpleString()``.

Drift outcome per table:
* no previous snapshot -> pass, detail records the baseline;
* removed column -> fail (``fail_on_column_removed``), type change -> fail
  (``fail_on_type_changed``); a flag that is off lists the issue without failing;
* added column -> warn (``warn_on_column_added``) only if still passing.
The detail always ends with the current schema as sorted JSON, the next baseline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tablewatch.functions.messages import (
    DRIFT_ADDED,
    DRIFT_BASELINE,
    DRIFT_CURRENT,
    DRIFT_NO_CHANGES,
    DRIFT_REMOVED,
    DRIFT_TYPE_CHANGES,
    render,
)
from tablewatch.functions.scalar import json_object_text, py_list_text, type_string
from tablewatch.operators.latest import latest_per_key

SNAPSHOT_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("position", IntegerType(), False),
        StructField("column_name", StringType(), False),
        StructField("data_type", StringType(), False),
    ]
)

# Markers that precede the embedded schema JSON in a drift detail (from the templates).
CURRENT_MARKER = DRIFT_CURRENT.split("{issues} | ")[1].split("{schema}")[0]
BASELINE_MARKER = DRIFT_BASELINE.split("-- ")[1].split("{schema}")[0]


def schema_snapshot(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Long-form snapshot of the given DataFrames' schemas (analysis only, no job)."""
    rows = [
        (name, i, f.name, type_string(f.dataType))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def check_schema_drift(
    current: DataFrame,
    previous: DataFrame | None,
    fail_on_column_removed: bool = True,
    fail_on_type_changed: bool = True,
    warn_on_column_added: bool = True,
) -> DataFrame:
    """One drift row per table of ``current``: table_name, check_type, column_name, status,
    measured (number of issues), threshold, detail, current_schema (JSON)."""
    cur = current.select("table_name", "column_name", F.col("data_type").alias("cur_type"))
    if previous is None:
        previous = current.sparkSession.createDataFrame([], "table_name string, column_name string, data_type string")
    prev = previous.select("table_name", "column_name", F.col("data_type").alias("prev_type"))
    j = cur.join(prev, ["table_name", "column_name"], "full_outer")
    cn, ct, pt = F.col("column_name"), F.col("cur_type"), F.col("prev_type")
    agg = j.groupBy("table_name").agg(
        F.max(ct.isNotNull()).alias("has_cur"),
        F.max(pt.isNotNull()).alias("has_prev"),
        F.collect_list(F.when(ct.isNull(), cn)).alias("removed"),
        F.collect_list(F.when(pt.isNull(), cn)).alias("added"),
        F.collect_list(F.when(ct.isNotNull() & pt.isNotNull() & (ct != pt), F.struct(cn.alias("c"), pt.alias("p"), ct.alias("n")))).alias("changed"),
        F.collect_list(F.when(ct.isNotNull(), F.struct(cn.alias("column_name"), ct.alias("data_type")))).alias("entries"),
    ).where(F.col("has_cur"))

    removed, added, changed = F.col("removed"), F.col("added"), F.array_sort(F.col("changed"))
    n_removed, n_added, n_changed = F.size(removed), F.size(added), F.size(changed)
    schema_json = json_object_text(F.col("entries"))
    status = F.lit("pass")
    if fail_on_column_removed:
        status = F.when(n_removed > 0, F.lit("fail")).otherwise(status)
    if fail_on_type_changed:
        status = F.when(n_changed > 0, F.lit("fail")).otherwise(status)
    if warn_on_column_added:
        status = F.when((n_added > 0) & (status == "pass"), F.lit("warn")).otherwise(status)
    changed_text = F.concat(
        F.lit("{"),
        F.array_join(F.transform(changed, lambda e: F.concat(
            F.lit("'"), e["c"], F.lit("': ('"), e["p"], F.lit("', '"), e["n"], F.lit("')"))), ", "),
        F.lit("}"),
    )
    issues = F.array_compact(F.array(
        F.when(n_removed > 0, render(DRIFT_REMOVED, columns=py_list_text(removed))),
        F.when(n_changed > 0, render(DRIFT_TYPE_CHANGES, changes=changed_text)),
        F.when(n_added > 0, render(DRIFT_ADDED, columns=py_list_text(added))),
    ))
    body = F.when(F.size(issues) > 0, F.array_join(issues, "; ")).otherwise(F.lit(DRIFT_NO_CHANGES))
    first = ~F.col("has_prev")
    return agg.select(
        "table_name",
        F.lit("schema_drift").alias("check_type"),
        F.lit(None).cast("string").alias("column_name"),
        F.when(first, F.lit("pass")).otherwise(status).alias("status"),
        F.when(first, F.lit(0.0)).otherwise((n_removed + n_added + n_changed).cast("double")).alias("measured"),
        F.lit(None).cast("double").alias("threshold"),
        F.when(first, render(DRIFT_BASELINE, schema=schema_json))
        .otherwise(render(DRIFT_CURRENT, issues=body, schema=schema_json)).alias("detail"),
        schema_json.alias("current_schema"),
    )


def snapshot_text(detail: Column) -> Column:
    """Schema JSON embedded in a drift detail: after the current-schema marker, else after
    the baseline marker, else NULL."""
    i = F.instr(detail, CURRENT_MARKER)
    k = F.instr(detail, BASELINE_MARKER)
    return (
        F.when(i > 0, F.substr(detail, i + F.lit(len(CURRENT_MARKER))))
        .when(k > 0, F.substr(detail, k + F.lit(len(BASELINE_MARKER))))
    )


def last_snapshot(results: DataFrame, baseline: str = "latest") -> DataFrame:
    """Previous schema per table from the newest ``schema_drift`` result row of each table,
    decoded to long form ``(table_name, column_name, data_type)``.

    ``baseline="latest"`` takes the newest drift result even if it failed, so a drift is
    reported once and then becomes the new normal; ``baseline="last_pass"`` only accepts
    results that did not fail, so a breaking change keeps failing until it is reverted."""
    if baseline not in ("latest", "last_pass"):
        raise ValueError("baseline must be 'latest' or 'last_pass'")
    order = [F.desc("checked_at")] + ([F.desc("check_result_id")] if "check_result_id" in results.columns else [])
    drift = results.where(F.col("check_type") == "schema_drift")
    if baseline == "last_pass":
        drift = drift.where(F.col("status") != "fail")
    latest = latest_per_key(drift, ["table_name"], order)
    parsed = latest.select(
        "table_name",
        F.from_json(snapshot_text(F.col("detail")), "map<string,string>").alias("m"),
    )
    return parsed.select("table_name", F.explode("m").alias("column_name", "data_type"))


def stamp_snapshot(snapshot: DataFrame, run_id: int, checked_at) -> DataFrame:
    """Snapshot rows ready to append to a typed snapshot table (one set per run)."""
    return snapshot.select(F.lit(run_id).cast("long").alias("run_id"), "table_name", "position", "column_name",
                           "data_type", checked_at.alias("checked_at"))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Previous schema per table from a typed snapshot table: every column row of the
    newest recorded run of each table (ties kept, so all its columns survive)."""
    latest = latest_per_key(snapshots, ["table_name"], [F.desc("checked_at"), F.desc("run_id")], ties=True)
    return latest.select("table_name", "column_name", "data_type")
