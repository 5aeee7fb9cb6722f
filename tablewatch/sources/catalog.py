"""Catalog sinks and listings, and the results sink.

Results are appended run by run: the partitions of a run, ``(check_date, run_id)``, are overwritten as
a whole, so a run that is written again is stored once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

INVENTORY_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("table_exists", BooleanType(), False),
        StructField("row_count", LongType(), True),
    ]
)


def write_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                path: str | None = None) -> None:
    w = df.write.mode(mode)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def table_inventory(spark: SparkSession, tables: dict[str, DataFrame | None] | list[str]) -> DataFrame:
    """One row per requested table: exists flag and row count; a missing table is a row, not an error.

    ``tables`` is a list of catalog names, or a mapping name -> DataFrame (None = missing).
    All counts run as one union of partial-aggregated branches (a single job).
    """
    if isinstance(tables, list):
        tables = {t: (spark.read.table(t) if spark.catalog.tableExists(t) else None) for t in tables}
    parts = []
    missing = []
    for name, df in tables.items():
        if df is None:
            missing.append((name, False, None))
        else:
            parts.append(
                df.agg(F.count(F.lit(1)).alias("row_count")).select(
                    F.lit(name).alias("table_name"), F.lit(True).alias("table_exists"), F.col("row_count")
                )
            )
    if missing:
        parts.append(spark.createDataFrame(missing, INVENTORY_SCHEMA))
    if not parts:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    return df.limit(n)


RUN_PARTITIONS = ("check_date", "run_id")


def append_results(results: DataFrame, path: str, unit: str = "run") -> None:
    """Store check results partitioned by check day, and by run unless ``unit`` is "day". History reports read
    only the days they need (partition pruning), and the rows of a run replace those that it stored before. With
    "day", for a history that is brought in as a whole, the rows of a day replace those of that day."""
    out = results.withColumn("check_date", F.to_date("checked_at")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(*(RUN_PARTITIONS if unit == "run" else RUN_PARTITIONS[:1])).parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Stored results; run_id, where it is a folder name, is a long again."""
    return spark.read.parquet(path).withColumn("run_id", F.col("run_id").cast("long"))


def append_results_table(spark: SparkSession, results: DataFrame, name: str) -> None:
    """The same for a catalog table. One that is partitioned otherwise gets only rows of ids it has not."""
    if not spark.catalog.tableExists(name):
        results.write.partitionBy(*RUN_PARTITIONS).saveAsTable(name)
        return
    stored = spark.read.table(name)
    if [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == list(RUN_PARTITIONS):
        mode = "spark.sql.sources.partitionOverwriteMode"  # an insert by name takes it from the session alone
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            results.select(*stored.columns).write.mode("overwrite").insertInto(name)
        finally:
            spark.conf.set(mode, before)
    else:
        results.join(stored.select("check_result_id"), "check_result_id", "left_anti").select(*stored.columns).write.insertInto(name)
