import json
import os
import tempfile

import pytest

from tablewatch import cli
from tablewatch.operators.runlog import current_runs, read_events


def test_lineage_then_blast_radius_then_suite(spark, capsys):
    d = tempfile.mkdtemp(prefix="tw-scripts-")
    with open(os.path.join(d, "load_a.py"), "w") as fh:
        fh.write('def run():\n    df = spark.read.csv("data/a.csv")\n    df.write.saveAsTable("stg_a")\n')
    with open(os.path.join(d, "build.py"), "w") as fh:
        fh.write('def run():\n    a = spark.table("stg_a")\n    a.select("x").write.saveAsTable("dim_a")\n'
                 '    b = spark.table(name)\n    b.write.saveAsTable("dim_b")\n')
    cli.main(["lineage", "--scripts", d, "--edges", "cli_edges"], spark)
    cli.main(["lineage", "--scripts", d, "--edges", "cli_edges"], spark)  # second run upserts
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert {(r["job_name"], r["target_table"]) for r in out} == {("build", "dim_b")}
    assert spark.read.table("cli_edges").count() == 2
    cli.main(["blast-radius", "--edges", "cli_edges", "data/a.csv"], spark)
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [(r["affected_table"], r["distance"]) for r in out] == [("dim_a", 2), ("stg_a", 1)]
    from datetime import datetime
    spark.createDataFrame([("manual", "dim_a", "report_a", datetime(2024, 1, 1))],
                          "job_name string, source_table string, target_table string, detected_at timestamp_ntz"
                          ).write.saveAsTable("cli_overrides")
    cli.main(["blast-radius", "--edges", "cli_edges", "--overrides", "cli_overrides", "stg_a"], spark)
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [(r["affected_table"], r["path_text"]) for r in out] == [("dim_a", "stg_a -> dim_a"),
                                                                    ("report_a", "stg_a -> dim_a -> report_a")]

    spark.createDataFrame([(1, "x"), (1, None)], "id int, v string").write.saveAsTable("cli_t")
    rules = os.path.join(d, "rules.yaml")
    with open(rules, "w") as fh:
        fh.write("data_quality:\n  tables:\n    - name: cli_t\n      key_columns: [id]\n"
                 "      null_check_columns: [v]\n      freshness_check: true\n")
    try:
        import yaml  # noqa: F401
    except ImportError:
        return
    cli.main(["suite", "--rules", rules, "--results", "cli_results", "--edges", "cli_edges", "--run-id", "5",
              "--as-of", "2024-01-31 00:00:00"], spark)
    tot = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert tot["checks_run"] == 4 and tot["checks_failed"] == 3
    # The suite logs itself, a repeated run is stored once, and failures come with radius and latency.
    args = ["suite", "--rules", rules, "--results", "cli_results", "--edges", "cli_edges", "--runs", os.path.join(d, "runs"), "--failures", "cli_failures", "--digest", "cli_digest"]
    for _ in range(2):
        cli.main([*args, "--run-id", "6"], spark)
    assert spark.read.table("cli_results").groupBy("run_id").count().orderBy("run_id").collect() == [(5, 4), (6, 4)]
    assert {r["affected_count"] for r in spark.read.table("cli_failures").collect()} == {0}
    with pytest.raises(Exception, match="no_such_baseline"):
        cli.main([*args, "--run-id", "7", "--as-of", "no_such_baseline"], spark)
    assert spark.read.table("cli_digest").where("block_no = 0 AND line_no = 1").first()["line"].startswith("Data Quality Alert -- ")
    runs = {r["run_id"]: r for r in current_runs(read_events(spark, os.path.join(d, "runs"))).collect()}
    assert (runs[6]["job_name"], runs[6]["status"], runs[6]["rows_written"]) == ("dq_check_run", "success", 4)
    assert runs[7]["status"] == "failed"


def test_job_list_config_skips_missing_and_init_creates_tables(spark, capsys):
    d = tempfile.mkdtemp(prefix="tw-jobs-")
    with open(os.path.join(d, "one.py"), "w") as fh:
        fh.write('x = spark.table("src_one")\nx.write.saveAsTable("dst_one")\n')
    cfg = os.path.join(d, "config.yaml")
    with open(cfg, "w") as fh:
        fh.write(f"pipeline_jobs:\n  - name: job_one\n    script_path: {d}/one.py\n"
                 f"  - name: job_gone\n    script_path: {d}/gone.py\n")
    cli.main(["lineage", "--config", cfg, "--edges", "cfg_edges", "--unresolved", "cfg_unresolved"], spark)
    rows = spark.read.table("cfg_edges").collect()
    assert [(r["job_name"], r["source_table"], r["target_table"]) for r in rows] == [("job_one", "src_one", "dst_one")]
    assert spark.read.table("cfg_unresolved").count() == 0
    cli.main(["init", "--prefix", "m_"], spark)
    made = [json.loads(x)["created"] for x in capsys.readouterr().out.splitlines() if "created" in x]
    assert set(made) == {"m_pipeline_run_events", "m_lineage_edges", "m_lineage_overrides", "m_dq_check_results",
                         "m_schema_snapshots"}
    cli.main(["inventory"], spark)
    inv = {json.loads(x)["table_name"] for x in capsys.readouterr().out.splitlines()}
    assert {"cfg_edges", "m_dq_check_results"} <= inv


def test_suite_with_typed_snapshots_detects_drift(spark, capsys):
    d = tempfile.mkdtemp(prefix="tw-snap-")
    rules = os.path.join(d, "rules.yaml")
    with open(rules, "w") as fh:
        fh.write("data_quality:\n  tables:\n    - name: snap_t\n      key_columns: [id]\n")
    spark.createDataFrame([(1, "x")], "id int, v string").write.saveAsTable("snap_t")
    args = ["suite", "--rules", rules, "--results", "snap_results", "--snapshots", "snap_snapshots"]
    cli.main(args + ["--run-id", "1", "--as-of", "2024-01-01 00:00:00"], spark)
    spark.sql("DROP TABLE snap_t")
    spark.createDataFrame([(1, 2)], "id int, v int").write.saveAsTable("snap_t")
    cli.main(args + ["--run-id", "2", "--as-of", "2024-01-02 00:00:00"], spark)
    capsys.readouterr()
    r = spark.read.table("snap_results").where("run_id = 2 AND check_type = 'schema_drift'").first()
    assert r["status"] == "fail" and r["detail"].startswith("type changes: {'v': ('string', 'int')}")
    assert spark.read.table("snap_snapshots").count() == 4


def test_load_jobs_and_warehouse_build_with_run_log(spark, capsys):
    from tests.test_warehouse import CUSTOMERS, ITEMS, ORDERS, PRODUCTS, SELLERS
    from tablewatch.operators.runlog import current_runs

    d = tempfile.mkdtemp(prefix="tw-load-")
    for entity, text in (("customers", CUSTOMERS), ("orders", ORDERS), ("order_items", ITEMS),
                         ("products", PRODUCTS), ("sellers", SELLERS)):
        path = os.path.join(d, f"{entity}.csv")
        with open(path, "w") as fh:
            fh.write(text)
        cli.main(["load", entity, "--source", path, "--target", f"stg_{entity}", "--runs", "cli_runs"], spark)
    cli.main(["build-warehouse", "--runs", "cli_runs"], spark)
    capsys.readouterr()
    runs = {r["job_name"]: r for r in current_runs(spark.read.table("cli_runs")).collect()}
    assert runs["load_customers"]["rows_read"] == 3 and runs["load_customers"]["rows_written"] == 2
    assert runs["build_warehouse"]["status"] == "success" and runs["build_warehouse"]["rows_written"] == 10
    assert spark.read.table("Fact_Order_Items").count() == 3
