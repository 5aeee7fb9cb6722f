"""Metadata tables: run events, lineage edges and overrides, check results.

``create_metadata_tables`` creates them empty in the session catalog (results partitioned
by check day and run, so history reports prune by day and a run is stored once). Rows are only ever appended; "current"
state is derived by the operators (``current_runs``, ``combine_edges``, ``latest_results``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tablewatch.sources.catalog import RUN_PARTITIONS

EVENT_SCHEMA = StructType(
    [
        StructField("run_id", LongType(), False),
        StructField("job_name", StringType(), False),
        StructField("event_time", TimestampNTZType(), False),
        StructField("status", StringType(), False),
        StructField("rows_read", LongType(), True),
        StructField("rows_written", LongType(), True),
        StructField("error_message", StringType(), True),
    ]
)

EDGE_SCHEMA = StructType([
    StructField("job_name", StringType(), False),
    StructField("source_table", StringType(), False),
    StructField("target_table", StringType(), False),
    StructField("source_type", StringType(), False),
    StructField("detected_at", TimestampNTZType(), False),
])

OVERRIDE_SCHEMA = StructType([
    StructField("job_name", StringType(), False),
    StructField("source_table", StringType(), False),
    StructField("target_table", StringType(), False),
    StructField("reason", StringType(), True),
    StructField("added_by", StringType(), True),
    StructField("detected_at", TimestampNTZType(), False),
])

RESULT_SCHEMA = StructType([
    StructField("check_result_id", LongType(), False),
    StructField("run_id", LongType(), False),
    StructField("table_name", StringType(), False),
    StructField("check_type", StringType(), False),
    StructField("column_name", StringType(), True),
    StructField("status", StringType(), False),
    StructField("measured", DoubleType(), True),
    StructField("threshold", DoubleType(), True),
    StructField("detail", StringType(), True),
    StructField("checked_at", TimestampNTZType(), False),
    StructField("check_date", DateType(), False),
])

SNAPSHOT_TABLE_SCHEMA = StructType([
    StructField("run_id", LongType(), False),
    StructField("table_name", StringType(), False),
    StructField("position", IntegerType(), False),
    StructField("column_name", StringType(), False),
    StructField("data_type", StringType(), False),
    StructField("checked_at", TimestampNTZType(), False),
])

TABLES = {
    "pipeline_run_events": (EVENT_SCHEMA, None),
    "lineage_edges": (EDGE_SCHEMA, None),
    "lineage_overrides": (OVERRIDE_SCHEMA, None),
    "dq_check_results": (RESULT_SCHEMA, RUN_PARTITIONS),
    "schema_snapshots": (SNAPSHOT_TABLE_SCHEMA, None),
}


def create_metadata_tables(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the missing metadata tables (``prefix`` e.g. ``"meta."``); returns the names."""
    made = []
    for name, (schema, part) in TABLES.items():
        full = f"{prefix}{name}"
        if spark.catalog.tableExists(full):
            continue
        w = spark.createDataFrame([], schema).write.format("parquet")
        if part:
            w = w.partitionBy(*part)
        w.saveAsTable(full)
        made.append(full)
    return made
