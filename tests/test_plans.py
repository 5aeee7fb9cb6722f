"""Plan-shape guards for the scale decisions (see README, "Design for scale")."""

import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablewatch.operators.checks import orphan_keys, table_checks
from tablewatch.operators.latest import latest_per_key
from tablewatch.plans.reports import dq_history
from tablewatch.sources.catalog import append_results


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _parquet(spark, df):
    path = tempfile.mkdtemp(prefix="tw-plan-") + "/t"
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = _parquet(spark, spark.range(1000).select((F.col("id") % 3).alias("k"), "id"))
    p = plan(latest_per_key(df, ["k"], [F.desc("id")]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_orphan_keys_reduce_both_sides_before_the_join(spark, no_broadcast):
    child = _parquet(spark, spark.range(1000).select((F.col("id") % 50).alias("fk"), "id"))
    parent = _parquet(spark, spark.range(40).select(F.col("id").alias("pk")))
    p = plan(orphan_keys(child, "fk", parent, "pk"))
    assert "LeftAnti" not in p and "LeftOuter" in p
    join_at = p.index("SortMergeJoin")
    assert p.count("HashAggregate", join_at) >= 4  # partial + final distinct on each side, below the join


def test_one_scan_per_table_for_all_null_and_duplicate_checks(spark):
    df = _parquet(spark, spark.range(100).select("id", (F.col("id") % 7).alias("a"), F.lit(None).cast("string").alias("b")))
    p = plan(table_checks(df, ["id", "a", "b"], ["a", "b"]))
    assert p.count("FileScan parquet") == 1


def test_history_prunes_partitions(spark):
    rows = [(1, "t", "null_check", None, "pass", 0.0, 1.0, "d", datetime(2024, 1, d)) for d in (1, 20, 30)]
    res = spark.createDataFrame(rows, "run_id long, table_name string, check_type string, column_name string, "
                                      "status string, measured double, threshold double, detail string, "
                                      "checked_at timestamp_ntz")
    path = tempfile.mkdtemp(prefix="tw-res-") + "/r"
    append_results(res, path)
    h = dq_history(spark.read.parquet(path), 7, datetime(2024, 1, 31))
    p = plan(h)
    assert "PartitionFilters: [isnotnull(check_date" in p
    assert [r["check_date"].day for r in h.collect()] == [30]
