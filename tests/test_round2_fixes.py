"""Cases of earlier wrong answers: mixed-type keys, one clock, zoned timestamps, run-log and script files."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tablewatch.functions.scalar import utc_now
from tablewatch.operators.checks import check_referential_integrity
from tablewatch.operators.freshness import check_freshness, last_successful_write
from tablewatch.operators.runlog import RunLog, current_runs, read_events
from tablewatch.plans.staging import parse_timestamps
from tablewatch.sources.files import read_job_scripts, read_scripts


@pytest.mark.parametrize(("child", "parent"), [("bigint", "double"), ("bigint", "decimal(10,2)"), ("int", "bigint"), ("string", "int"), ("int", "string")])
def test_mixed_type_keys_compare_by_value(spark, child, parent):
    c = spark.createDataFrame([(1,), (2,), (None,)], "k long").select(F.col("k").cast(child))
    p = spark.createDataFrame([(1,), (2,)], "id long").select(F.col("id").cast(parent))
    assert check_referential_integrity(c, "k", p, "id").first()["measured"] == 0
    q = p.where(F.col("id") == 1)
    row = check_referential_integrity(c, "k", q, "id").first()
    assert (row["status"], row["measured"]) == ("fail", 1.0)


def test_text_that_is_no_number_is_an_orphan(spark):
    c = spark.createDataFrame([("1",), ("x",)], "k string")
    p = spark.createDataFrame([(1,)], "id int")
    assert check_referential_integrity(c, "k", p, "id").first()["measured"] == 1


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_fresh_write_is_fresh_in_every_zone(spark, tmp_path, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        path = str(tmp_path / "runs")
        with RunLog(spark, path, "job").run():
            pass
        runs = current_runs(read_events(spark, path))
        edges = spark.createDataFrame([("job", "t", datetime(2024, 1, 1))], "job_name string, target_table string, detected_at timestamp_ntz")
        got = check_freshness(spark.createDataFrame([("t",)], "table_name string"), edges, runs).first()
        assert got["status"] == "pass" and 0 <= got["measured"] < 0.1
        assert abs(spark.range(1).select(utc_now()).first()[0] - datetime.now(timezone.utc).replace(tzinfo=None)) < timedelta(minutes=5)
        got = parse_timestamps(spark.createDataFrame([("2024-01-01 10:00:00+05:00", "2024-01-01 10:00:00")], "a string, b string"), ["a", "b"]).first()
        assert (got["a"], got["b"]) == (datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 10))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_writes_after_as_of_do_not_count(spark):
    runs = spark.createDataFrame([("j", "success", datetime(2024, 1, 1)), ("j", "success", datetime(2024, 1, 3))], "job_name string, status string, finished_at timestamp_ntz")
    assert last_successful_write(runs, "2024-01-02 00:00:00").first()["last_written_at"] == datetime(2024, 1, 1)


def test_run_with_an_unused_observation_ends(spark, tmp_path):
    path = str(tmp_path / "runs")
    with RunLog(spark, path, "job").run() as run:
        run.observe_read(spark.range(3))  # never executed
    assert current_runs(read_events(spark, path)).first()["status"] == "success"


def test_scripts_with_blanks_and_equal_names_stay(spark, tmp_path):
    for folder in ("a b", "c"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "load.py").write_text(f"# {folder}")
    got = read_job_scripts(spark, {"one": str(tmp_path / "a b" / "load.py"), "two": str(tmp_path / "c" / "load.py"), "gone": str(tmp_path / "x.py")})
    assert {r["job_name"]: r["script_text"] for r in got.collect()} == {"one": "# a b", "two": "# c"}
    got = read_scripts(spark, str(tmp_path))
    assert {r["job_name"]: r["script_text"] for r in got.collect()} == {"a b/load": "# a b", "c/load": "# c"}
