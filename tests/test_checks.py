from pyspark.sql import functions as F

from tablewatch.operators.checks import check_duplicates, check_nulls, check_referential_integrity, table_checks
from tablewatch.operators.faults import break_foreign_key


def by_col(df):
    return {r["column_name"]: r for r in df.collect()}


def test_null_rates_threshold_and_missing_column(spark):
    # 1 null in 100 rows is exactly 1.0 %: strict > passes; 2 nulls fail.
    data = [(i, None if i < 1 else "x", None if i < 2 else "y") for i in range(100)]
    df = spark.createDataFrame(data, "id int, a string, b string")
    r = by_col(check_nulls(df, ["id", "a", "b", "gone"], 1.0))
    assert r["id"]["status"] == "pass" and r["id"]["measured"] == 0.0
    assert r["a"]["status"] == "pass" and r["a"]["measured"] == 1.0
    assert r["a"]["detail"] == "null_rate=1.00%, threshold=1.0%, null_count=1, total_rows=100"
    assert r["b"]["status"] == "fail"
    assert r["gone"]["status"] == "fail"
    assert r["gone"]["detail"] == "column 'gone' not found in table (schema drift?)"


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "id int, a string")
    r = {x["check_type"]: x for x in table_checks(df, ["a"], ["id"]).collect()}
    assert r["null_check"]["status"] == "pass" and r["null_check"]["measured"] == 0.0
    assert r["duplicate_check"]["status"] == "pass" and r["duplicate_check"]["measured"] == 0.0


def test_duplicates_count_surplus_rows_and_null_keys(spark):
    # keys: (1,1) x3, (NULL,1) x2, (NULL,NULL) x1 -> 6 rows, 3 distinct tuples -> 3 surplus.
    data = [(1, 1), (1, 1), (1, 1), (None, 1), (None, 1), (None, None)]
    df = spark.createDataFrame(data, "a int, b int")
    r = check_duplicates(df, ["a", "b"], 0.5).collect()[0]
    assert r["column_name"] == "a,b"
    assert r["measured"] == 50.0 and r["status"] == "fail"
    assert r["detail"] == "duplicate_rate=50.00%, threshold=0.5%, duplicate_count=3, total_rows=6"


def test_missing_key_column_is_a_fail_row(spark):
    df = spark.createDataFrame([(1,)], "a int")
    r = check_duplicates(df, ["a", "zz"]).collect()[0]
    assert r["status"] == "fail" and "zz" in r["detail"]


def test_referential_integrity_counts_distinct_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,), (9,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,), (3,)], "pk int")
    r = check_referential_integrity(child, "fk", parent, "pk").collect()[0]
    assert r["status"] == "fail" and r["measured"] == 2.0
    assert r["detail"] == "orphan_key_count=2 (distinct 'fk' values with no matching 'pk' in parent table)"
    w = check_referential_integrity(child, "fk", parent, "pk", fail_on_any_orphan=False).collect()[0]
    assert w["status"] == "warn"
    ok = check_referential_integrity(parent, "pk", parent, "pk").collect()[0]
    assert ok["status"] == "pass" and ok["measured"] == 0.0


def test_referential_integrity_mixed_types(spark):
    child = spark.createDataFrame([("1",), ("x",)], "fk string")
    parent = spark.createDataFrame([(1,)], "pk bigint")
    r = check_referential_integrity(child, "fk", parent, "pk").collect()[0]
    assert r["measured"] == 1.0


def test_broken_foreign_keys_are_detected_and_rows_kept(spark):
    fact = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 20).alias("cust"))
    dim = spark.range(20).select(F.col("id").alias("cust"))
    broken = break_foreign_key(fact, ["k"], "cust", n=50, prefix="INVALID_CUSTOMER_")
    assert broken.count() == 500
    r = check_referential_integrity(broken, "cust", dim, "cust").collect()[0]
    assert r["status"] == "fail" and r["measured"] == 50.0
    fakes = broken.where(F.col("cust").startswith("INVALID_")).select("k").collect()
    assert sorted(x["k"] for x in fakes) == list(range(50))
