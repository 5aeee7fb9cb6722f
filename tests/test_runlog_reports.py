import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablewatch.operators.digest import failure_digest
from tablewatch.operators.runlog import RunLog, current_runs, read_events
from tablewatch.plans import reports as RP

T0 = datetime(2024, 1, 31, 9, 0, 0)
RSCHEMA = "run_id long, table_name string, check_type string, column_name string, status string, detail string, checked_at timestamp_ntz"


def results(spark):
    return spark.createDataFrame([
        (1, "t1", "null_check", "a", "fail", "x", T0 - timedelta(days=1)),
        (2, "t1", "null_check", "a", "pass", "x", T0),
        (2, "t1", "null_check", "b", "warn", "x", T0),       # tie on latest time: both kept
        (2, "t2", "freshness", None, "fail", "stale", T0),
        (2, "t3", "duplicate_check", "k", "pass", "ok", T0),
    ], RSCHEMA)


def test_run_log_events_and_observed_counts(spark):
    path = tempfile.mkdtemp(prefix="tw-runs-") + "/runs"
    log = RunLog(spark, path, "load_x")
    with pytest.raises(RuntimeError):
        log.finish("success")
    with log.run(run_id=7) as run:
        df = run.observe_read(spark.range(10))
        out = run.observe_write(df.where("id < 4"))
        out.write.format("noop").mode("overwrite").save()
    bad = RunLog(spark, path, "load_y")
    with pytest.raises(ValueError):
        with bad.run(run_id=8):
            raise ValueError("boom")
    cur = {r["run_id"]: r for r in current_runs(read_events(spark, path)).collect()}
    assert cur[7]["status"] == "success" and cur[7]["rows_read"] == 10 and cur[7]["rows_written"] == 4
    assert cur[8]["status"] == "failed" and cur[8]["error_message"] == "boom"
    assert cur[7]["duration_seconds"] is not None


def test_latest_keeps_ties_and_worst_status(spark):
    r = results(spark)
    latest = RP.latest_results(r).collect()
    assert len(latest) == 4
    st = {x["table_name"]: x["status"] for x in RP.status_per_table(r).collect()}
    assert st == {"t1": "warn", "t2": "fail", "t3": "pass"}
    summ = {x["status"]: x["check_count"] for x in RP.dq_summary(r).collect()}
    assert summ == {"pass": 2, "warn": 1, "fail": 1}


def test_history_pivot_fills_zeros(spark):
    h = RP.dq_history(results(spark), 7, T0)
    p = {x["check_date"].day: (x["pass"], x["warn"], x["fail"]) for x in RP.dq_history_pivot(h).collect()}
    assert p == {30: (0, 0, 1), 31: (2, 1, 1)}


def test_digest_only_fails_and_none_without_fails(spark):
    r = results(spark)
    radius = spark.createDataFrame([("t2", "t9"), ("t2", "t8")], "failing_table string, affected_table string")
    d = {x["run_id"]: x for x in failure_digest(r, radius, T0).collect()}
    assert set(d) == {1, 2}
    body = d[2]["body"]
    assert d[2]["subject"] == "[DQ Alert] 1 check(s) failing"
    assert "Blast radius: 2 table(s) potentially affected -- t8, t9" in body
    assert "Generated: 2024-01-31T09:00:00" in body
    assert "Blast radius: none (failure contained to this table)" in d[1]["body"]
    assert failure_digest(r.where(F.col("status") != "fail"), radius, T0).count() == 0


def test_drilldown_has_every_node_of_the_graph(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "t2"), ("a", "t2"), ("t2", "d")], "source_table string, target_table string")
    got = {tuple(x) for x in RP.table_drilldown(edges, results(spark)).collect()}
    assert got == {("a", 0, 3, "not checked", False), ("b", 1, 2, "not checked", False), ("t2", 2, 1, "fail", True), ("d", 3, 0, "not checked", False)}
    one = RP.table_drilldown(edges, results(spark), spark.createDataFrame([("t2",)], "table_name string"))
    assert [tuple(x) for x in one.collect()] == [("t2", 2, 1, "fail", True)]


def test_drilldown_query_reads_the_whole_table(spark, tmp_path):
    from tablewatch.plans import registered

    spark.range(1, 9).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(11, 2, "{}", T0), (12, 40, "{}", T0)], "event_id long, user_id long, props string, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    got = {x["table_name"]: (x["n_upstream"], x["n_downstream"], x["status"]) for x in registered.q_table_drilldown(spark, str(tmp_path)).collect()}
    assert set(got) == {f"tbl_{i}" for i in range(9)}
    assert got["tbl_2"] == (1, 4, "fail") and got["tbl_0"] == (0, 8, "not checked") and got["tbl_8"] == (2, 0, "not checked")
