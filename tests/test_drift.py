from datetime import datetime

import pytest

from tablewatch.operators.drift import check_schema_drift, last_snapshot, schema_snapshot

BASE = [("id", "bigint"), ("name", "string"), ("size", "int")]


def snap(spark, cols, table="t"):
    return spark.createDataFrame([(table, c, t) for c, t in cols], "table_name string, column_name string, data_type string")


def run(spark, prev, cur, **flags):
    p = None if prev is None else snap(spark, prev)
    return check_schema_drift(snap(spark, cur), p, **flags).collect()[0]


def test_first_snapshot_is_baseline(spark):
    r = run(spark, None, BASE)
    assert r["status"] == "pass"
    assert r["detail"] == 'no prior snapshot -- recording baseline: {"id": "bigint", "name": "string", "size": "int"}'


@pytest.mark.parametrize("cur,status,start", [
    (BASE, "pass", "no schema changes detected"),
    (BASE[:2], "fail", "removed columns: ['size']"),
    ([("id", "bigint"), ("name", "string"), ("size", "bigint")], "fail", "type changes: {'size': ('int', 'bigint')}"),
    (BASE + [("b", "string")], "warn", "added columns: ['b']"),
    (BASE[:2] + [("b", "string")], "fail", "removed columns: ['size']; added columns: ['b']"),
])
def test_drift_cases(spark, cur, status, start):
    r = run(spark, BASE, cur)
    assert r["status"] == status
    assert r["detail"].startswith(start + " | current_schema: {")


def test_flags_off_list_but_do_not_change_status(spark):
    r = run(spark, BASE, BASE + [("b", "string")], warn_on_column_added=False)
    assert r["status"] == "pass" and r["detail"].startswith("added columns: ['b']")
    r = run(spark, BASE, BASE[:2], fail_on_column_removed=False)
    assert r["status"] == "pass" and r["detail"].startswith("removed columns: ['size']")


def test_snapshot_round_trip_through_results(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    cur = schema_snapshot(spark, {"t": df}).select("table_name", "column_name", "data_type")
    first = check_schema_drift(cur, None).collect()[0]
    results = spark.createDataFrame(
        [(1, "t", "schema_drift", first["detail"], datetime(2024, 1, 1))],
        "check_result_id long, table_name string, check_type string, detail string, checked_at timestamp_ntz")
    prev = last_snapshot(results)
    again = check_schema_drift(cur, prev).collect()[0]
    assert again["status"] == "pass" and again["detail"].startswith("no schema changes detected")


def test_suite_output_feeds_the_next_drift_run(spark):
    from datetime import datetime

    from tablewatch.plans.suite import run_suite
    from tablewatch.sources.rules import Rules, TableRule

    rules = Rules(tables=(TableRule("t"),))
    v1 = spark.createDataFrame([(1, "a")], "id bigint, name string")
    first = run_suite(spark, {"t": v1}, rules, 1, datetime(2024, 1, 1))
    v2 = v1.withColumn("extra", v1.id * 2)
    second = run_suite(spark, {"t": v2}, rules, 2, datetime(2024, 1, 2), last_snapshot(first))
    r = second.where("check_type = 'schema_drift'").first()
    assert r["status"] == "warn" and r["detail"].startswith("added columns: ['extra']")


def test_last_pass_baseline_keeps_failing_until_reverted(spark):
    from datetime import datetime

    from tablewatch.plans.suite import run_suite
    from tablewatch.sources.rules import Rules, TableRule

    rules = Rules(tables=(TableRule("t"),))
    v1 = spark.createDataFrame([(1, "a")], "id bigint, name string")
    v2 = v1.drop("name")
    h1 = run_suite(spark, {"t": v1}, rules, 1, datetime(2024, 1, 1))
    h2 = h1.unionByName(run_suite(spark, {"t": v2}, rules, 2, datetime(2024, 1, 2), last_snapshot(h1)))
    latest = run_suite(spark, {"t": v2}, rules, 3, datetime(2024, 1, 3), last_snapshot(h2)).where("check_type = 'schema_drift'")
    strict = run_suite(spark, {"t": v2}, rules, 3, datetime(2024, 1, 3), last_snapshot(h2, "last_pass")).where(
        "check_type = 'schema_drift'")
    assert latest.first()["status"] == "pass" and strict.first()["status"] == "fail"
