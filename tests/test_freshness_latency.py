from datetime import datetime, timedelta

from tablewatch.operators.freshness import NO_WRITE_DETAIL, check_freshness
from tablewatch.operators.latency import UNKNOWN_LATENCY, detection_latency

T0 = datetime(2024, 1, 10, 12, 0, 0)


def frames(spark, finished):
    tables = spark.createDataFrame([("stg_a",), ("stg_b",), ("stg_c",)], "table_name string")
    edges = spark.createDataFrame([("job_a", "stg_a", T0), ("job_b", "stg_b", T0)],
                                  "job_name string, target_table string, detected_at timestamp_ntz")
    runs = spark.createDataFrame([("job_a", "success", finished), ("job_a", "failed", finished + timedelta(hours=1)),
                                  ("job_b", "running", None)],
                                 "job_name string, status string, finished_at timestamp_ntz")
    return tables, edges, runs


def test_stale_after_30_hours(spark):
    tables, edges, runs = frames(spark, T0)
    r = {x["table_name"]: x for x in check_freshness(tables, edges, runs, 24, T0 + timedelta(hours=30)).collect()}
    assert r["stg_a"]["status"] == "fail" and r["stg_a"]["measured"] == 30.0
    assert r["stg_a"]["detail"] == "last_written=2024-01-10T12:00:00, staleness=30.00h, threshold=24h"
    assert r["stg_b"]["status"] == "fail" and r["stg_b"]["detail"] == NO_WRITE_DETAIL
    assert r["stg_c"]["status"] == "fail" and r["stg_c"]["job_name"] is None


def test_exactly_at_threshold_passes(spark):
    tables, edges, runs = frames(spark, T0)
    r = {x["table_name"]: x for x in check_freshness(tables, edges, runs, 24, T0 + timedelta(hours=24)).collect()}
    assert r["stg_a"]["status"] == "pass"


def test_latency_uses_last_write_before_check(spark):
    tables, edges, runs = frames(spark, T0)
    checks = spark.createDataFrame([("stg_a", T0 + timedelta(seconds=42)), ("stg_a", T0 + timedelta(minutes=30)),
                                    ("stg_a", T0 - timedelta(hours=1)), ("stg_b", T0), ("stg_a", T0 + timedelta(hours=5))],
                                   "table_name string, checked_at timestamp_ntz")
    got = {(r["checked_at"]): r for r in detection_latency(checks, edges, runs).collect()}
    assert got[T0 + timedelta(seconds=42)]["latency_human"] == "42 seconds"
    assert got[T0 + timedelta(minutes=30)]["latency_human"] == "30.0 minutes"
    assert got[T0 + timedelta(hours=5)]["latency_human"] == "5.00 hours"
    assert got[T0 - timedelta(hours=1)]["latency_human"] == UNKNOWN_LATENCY
    assert got[T0]["last_written_at"] is None
