from datetime import datetime

from tablewatch.operators.drift import schema_snapshot
from tablewatch.operators.faults import drop_column
from tablewatch.operators.checks import check_foreign_keys
from tablewatch.plans.suite import run_suite, suite_totals
from tablewatch.sources.rules import ForeignKey, Rules, TableRule, rules_from_dict

CONFIG = {"data_quality": {
    "null_checks": {"max_null_rate_pct": 1.0},
    "duplicate_checks": {"max_duplicate_rate_pct": 0.5},
    "referential_integrity": {"fail_on_any_orphan": True},
    "freshness_checks": {"max_staleness_hours": 24},
    "schema_drift": {"fail_on_column_removed": True, "fail_on_type_changed": True, "warn_on_column_added": True},
    "tables": [
        {"name": "stg_customers", "key_columns": ["customer_id"],
         "null_check_columns": ["customer_id", "customer_city", "customer_state"], "freshness_check": True},
        {"name": "fact", "key_columns": ["order_id"], "null_check_columns": ["customer_id"],
         "referential_integrity": [{"column": "customer_id", "parent_table": "stg_customers", "parent_column": "customer_id"}]},
        {"name": "missing_table", "null_check_columns": ["x"]},
    ]}}


def test_schema_drift_injection_is_detected_end_to_end(spark):
    rules = rules_from_dict(CONFIG)
    customers = spark.createDataFrame([("c1", "sao paulo", "SP"), ("c2", "rio", "RJ")],
                                      "customer_id string, customer_city string, customer_state string")
    fact = spark.createDataFrame([("o1", "c1"), ("o2", "c3")], "order_id string, customer_id string")
    previous = schema_snapshot(spark, {"stg_customers": customers, "fact": fact}).drop("position")
    tables = {"stg_customers": drop_column(customers, "customer_city"), "fact": fact}
    res = run_suite(spark, tables, rules, 42, datetime(2024, 1, 31), previous)
    got = {(r["table_name"], r["check_type"], r["column_name"]): r for r in res.collect()}
    assert got[("stg_customers", "schema_drift", None)]["status"] == "fail"
    assert got[("stg_customers", "null_check", "customer_city")]["detail"].endswith("not found in table (schema drift?)")
    assert got[("fact", "referential_integrity", "customer_id")]["measured"] == 1.0
    assert got[("stg_customers", "freshness", None)]["status"] == "fail"
    assert got[("missing_table", "table_exists", None)]["status"] == "fail"
    assert got[("fact", "schema_drift", None)]["status"] == "pass"
    t = suite_totals(res).collect()[0]
    assert t["run_id"] == 42 and t["checks_run"] == len(got) and t["rows_read"] == t["checks_run"]


def test_batched_suite_equals_single_plan(spark):
    from functools import reduce

    from pyspark.sql import DataFrame

    from tablewatch.plans.suite import iter_suite

    rules = rules_from_dict(CONFIG)
    customers = spark.createDataFrame([("c1", "x", "SP")], "customer_id string, customer_city string, customer_state string")
    fact = spark.createDataFrame([("o1", "c1")], "order_id string, customer_id string")
    tables = {"stg_customers": customers, "fact": fact}
    whole = run_suite(spark, tables, rules, 1, datetime(2024, 1, 31))
    parts = list(iter_suite(spark, tables, rules, 1, tables_per_plan=1, as_of=datetime(2024, 1, 31)))
    assert len(parts) == 3
    key = lambda r: (r["table_name"], r["check_type"], r["column_name"] or "")
    assert sorted(reduce(DataFrame.unionByName, parts).collect(), key=key) == sorted(whole.collect(), key=key)


def test_two_keys_of_one_column_have_two_ids(spark):
    """Equal orphan counts and column names: only the parents differ."""
    t = {"c": spark.createDataFrame([(1,), (2,)], "x long"), "a": spark.createDataFrame([(1,)], "id long"), "b": spark.createDataFrame([(2,)], "id long")}
    rules = Rules(tables=(TableRule("c", (), (), False, (ForeignKey("x", "a", "id"), ForeignKey("x", "b", "id"), ForeignKey("x", "gone", "id"))),))
    got = run_suite(spark, t, rules, 3, "2024-01-31 00:00:00", with_ids=True).where("check_type = 'referential_integrity'").collect()
    assert len(got) == 3 and len({r["check_result_id"] for r in got}) == 3
    again = run_suite(spark, t, rules, 3, "2024-01-31 00:00:00", with_ids=True).collect()
    assert {r["check_result_id"] for r in got} <= {r["check_result_id"] for r in again}


def test_all_foreign_keys_of_a_table_take_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, "1", 1.0, None), (2, "x", 2.5, 7), (3, None, 3.0, 7)], "a long, b string, c double, d int").write.parquet(str(tmp_path / "child"))
    spark.createDataFrame([(1, "1", 7)], "k int, t string, d long").write.parquet(str(tmp_path / "parent"))
    child, parent = spark.read.parquet(str(tmp_path / "child")), spark.read.parquet(str(tmp_path / "parent"))
    keys = [("a", parent, "k"), ("b", parent, "k"), ("c", parent, "k"), ("d", parent, "d"), ("b", parent, "t"), ("no", parent, "k"), ("a", parent, "no")]
    df = check_foreign_keys(child, keys, numbered=True)
    assert [(r["fk_no"], r["column_name"], r["status"], r["measured"]) for r in df.collect()] == [
        (0, "a", "fail", 2.0), (1, "b", "fail", 1.0), (2, "c", "fail", 2.0), (3, "d", "pass", 0.0), (4, "b", "fail", 1.0), (5, "no", "fail", None), (6, "a", "fail", None)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [a") == 1
