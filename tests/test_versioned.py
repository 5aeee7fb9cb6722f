"""Atomic replacement, results stored once, and the event folder: kills between steps and retries."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablewatch.operators import runlog
from tablewatch.operators.runlog import EVENT_SCHEMA, RunLog, compact_events, current_runs, read_events, write_events
from tablewatch.sources import versioned
from tablewatch.sources.catalog import append_results, append_results_table, read_results
from tablewatch.sources.versioned import ConcurrentReplace, VersionedTable, current, is_view, repair, replace_table

T0 = datetime(2024, 1, 31, 9)


class Killed(Exception):
    pass


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.mark.parametrize("first", ["plain table", "versioned"])
@pytest.mark.parametrize(("owner", "step"), [(VersionedTable, "_write_data"), (VersionedTable, "_prepare"), (VersionedTable, "_commit"), (versioned, "repair")])
@pytest.mark.parametrize("after", [False, True])
def test_a_kill_at_any_step_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, first, owner, step, after):
    name, path = f"swap_{abs(hash((first, step, after))) % 10**9}", str(tmp_path / "t")
    if first == "versioned":
        replace_table(spark, spark.range(3), name, path)
    else:
        spark.range(3).write.saveAsTable(name)
    real = getattr(owner, step)

    def killed(*a, **k):
        if after:
            real(*a, **k)
        raise Killed

    monkeypatch.setattr(owner, step, killed)
    with pytest.raises(Killed):
        replace_table(spark, current(spark, name, path).where("id > 0").withColumn("more", F.lit("x")), name, path)
    monkeypatch.undo()
    new = step == "repair" or (step == "_commit" and after)
    assert ids(current(spark, name, path)) == ([1, 2] if new else [0, 1, 2])
    assert ids(spark.read.table(name)) == ([1, 2] if step == "repair" and after else [0, 1, 2])  # in full, never half
    if new:
        repair(spark, name, path)
        assert ids(spark.read.table(name)) == [1, 2] and spark.read.table(name).columns == ["id", "more"]
    # The next writer is not disturbed by what a killed one left.
    replace_table(spark, current(spark, name, path).where("id = 1"), name, path)
    assert ids(spark.read.table(name)) == ids(current(spark, name, path)) == [1] and is_view(spark, name)
    spark.sql(f"DROP VIEW {name}")


def test_versions_vacuum_empty_tables_and_two_writers(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "v"))
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.write(spark.range(2)) == 1 and t.write(spark.range(0)) == 2 and t.write(t.read(1).where("id = 1")) == 3
    assert ids(t.read()) == [1] and ids(t.read(2)) == [] and ids(t.read(1)) == [0, 1]
    assert t.read(2).columns == ["id"]
    late = t._prepare("x", t.read().schema)
    with pytest.raises(ConcurrentReplace):
        t._commit(3, late)
    assert t.vacuum(keep=2) == 1 and t.versions() == [2, 3] and ids(t.read()) == [1]


def results(spark, run, n=3, status="pass"):
    rows = [(run * 100 + i, run, f"t{i}", "null_check", "c", status, 0.0, 1.0, "d", T0 + timedelta(hours=12 * i)) for i in range(n)]
    return spark.createDataFrame(rows, "check_result_id long, run_id long, table_name string, check_type string, column_name string, status string, measured double, threshold double, detail string, checked_at timestamp_ntz")


def test_a_run_written_twice_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "results")
    append_results(results(spark, 1), path)
    append_results(results(spark, 2, 2), path)
    append_results(results(spark, 1, status="fail"), path)
    got = read_results(spark, path)
    assert sorted((r.check_result_id, r.status) for r in got.collect()) == [(100, "fail"), (101, "fail"), (102, "fail"), (200, "pass"), (201, "pass")]
    assert dict(got.dtypes)["run_id"] == "bigint"


@pytest.mark.parametrize("partitions", [("check_date", "run_id"), ("check_date",)])
def test_a_run_appended_twice_to_a_table_is_stored_once(spark, partitions):
    name = f"res_{len(partitions)}"
    rows = lambda run: results(spark, run).withColumn("check_date", F.to_date("checked_at"))
    if len(partitions) == 1:  # a table of an earlier layout
        rows(1).write.partitionBy(*partitions).saveAsTable(name)
    for run in (1, 2, 1, 2):
        append_results_table(spark, rows(run), name)
    assert ids(spark.read.table(name).select("check_result_id")) == [100, 101, 102, 200, 201, 202]


def test_a_retried_finish_is_one_row(spark, tmp_path):
    path = str(tmp_path / "runs")
    log = RunLog(spark, path, "job")
    log.start(5)
    log.start(5)
    log.finish("failed", error_message="x")
    log.finish("success", 1, 2)
    got = read_events(spark, path).collect()
    assert sorted(r.status for r in got) == ["running", "success"]
    assert [(r.run_id, r.status, r.rows_written) for r in current_runs(read_events(spark, path)).collect()] == [(5, "success", 2)]


def test_compaction_bounds_the_files_and_survives_a_kill(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    rows = [(k, "job", T0 + timedelta(seconds=k + s), "success" if s else "running", None, k if s else None, None) for k in range(200) for s in (0, 1) if s == 0 or k % 10]
    write_events(spark.createDataFrame(rows, EVENT_SCHEMA), path)
    want = sorted(map(str, current_runs(spark.createDataFrame(rows, EVENT_SCHEMA)).collect()))
    state = lambda: sorted(map(str, current_runs(read_events(spark, path)).collect()))
    assert state() == want

    def killed(*a, **k):
        raise Killed

    for step in ("_commit", "vacuum"):  # before the move counts, and after everything moved
        monkeypatch.setattr(runlog.VersionedTable, step, killed)
        with pytest.raises(Killed):
            compact_events(spark, path)
        monkeypatch.undo()
        assert state() == want
    assert compact_events(spark, path) == 0 and state() == want
    files = [f for f in (tmp_path / "runs").rglob("*.parquet")]
    assert len([f for f in files if "compacted" in str(f)]) <= 2
    assert len([f for f in files if "recent" in str(f)]) == 20  # the runs that have not ended
    log = RunLog(spark, path, "job")
    log.run_id = 0
    log.finish("success", 7, 7)
    assert compact_events(spark, path) == 1
    assert {r.run_id: r.rows_written for r in current_runs(read_events(spark, path)).collect()}[0] == 7


def test_a_count_is_there_when_the_action_is_over_and_null_without_one(spark, tmp_path):
    path = str(tmp_path / "runs")
    for k in range(5):
        with RunLog(spark, path, "job").run(k) as run:
            run.observe_write(run.observe_read(spark.range(100 + k)).where("id < 50")).write.format("noop").mode("overwrite").save()
    with RunLog(spark, path, "job").run(9) as run:
        run.observe_read(spark.range(3))  # never executed
    got = {r.run_id: (r.rows_read, r.rows_written) for r in current_runs(read_events(spark, path)).collect()}
    assert got == {k: (100 + k, 50) for k in range(5)} | {9: (None, None)}
