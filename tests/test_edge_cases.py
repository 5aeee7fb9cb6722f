from tablewatch.operators.asof import asof_backward
from tablewatch.operators.checks import check_referential_integrity, table_checks
from tablewatch.operators.extract import extract_lineage
from tablewatch.operators.graph import blast_radius, downstream
from tablewatch.plans.reports import failing_with_blast_radius

ESCHEMA = "source_table string, target_table string"


def test_empty_graph_and_unknown_starts(spark):
    e = spark.createDataFrame([], ESCHEMA)
    assert downstream(e).count() == 0
    starts = spark.createDataFrame([("x",)], "table_name string")
    r = blast_radius(e, starts)
    assert r.count() == 0 and r.columns == ["failing_table", "affected_table", "distance", "path", "path_text"]


def test_failing_table_outside_the_graph_has_zero_radius(spark):
    from datetime import datetime
    e = spark.createDataFrame([("a", "b")], ESCHEMA)
    res = spark.createDataFrame([("lonely", "null_check", "c", "fail", "d", datetime(2024, 1, 1))],
                                "table_name string, check_type string, column_name string, status string, detail string, "
                                "checked_at timestamp_ntz")
    r = failing_with_blast_radius(e, res).collect()
    assert len(r) == 1 and r[0]["affected_count"] == 0


def test_checks_with_only_missing_columns_and_empty_parent(spark):
    df = spark.createDataFrame([(1,)], "a int")
    rows = table_checks(df, ["x", "y"], ["z"]).collect()
    assert sorted((r["check_type"], r["column_name"], r["status"]) for r in rows) == [
        ("duplicate_check", "z", "fail"), ("null_check", "x", "fail"), ("null_check", "y", "fail")]
    parent = spark.createDataFrame([], "a int")
    r = check_referential_integrity(df, "a", parent, "a").first()
    assert r["status"] == "fail" and r["measured"] == 1.0
    missing_parent_col = check_referential_integrity(df, "a", parent.withColumnRenamed("a", "b"), "a").first()
    assert missing_parent_col["status"] == "fail"


def test_empty_corpus_and_empty_asof_sides(spark):
    corpus = spark.createDataFrame([], "job_name string, script_text string")
    assert extract_lineage(corpus).count() == 0
    left = spark.createDataFrame([], "k string, t timestamp_ntz")
    right = spark.createDataFrame([], "k string, rt timestamp_ntz")
    for m in ("range", "bucket"):
        assert asof_backward(left, right, ["k"], "t", "rt", method=m).count() == 0
    from datetime import datetime
    left2 = spark.createDataFrame([("a", datetime(2024, 1, 1))], "k string, t timestamp_ntz")
    for m in ("range", "bucket"):
        assert asof_backward(left2, right, ["k"], "t", "rt", out="v", method=m).first()["v"] is None
