"""Exact text of the digest and the console lines, compared with plain-Python renderings."""

from datetime import datetime

from tablewatch.operators.digest import failure_digest
from tablewatch.plans.reports import report_lines

T0 = datetime(2024, 1, 31, 9, 30, 0)
SCHEMA = ("run_id long, table_name string, check_type string, column_name string, status string, detail string, "
          "checked_at timestamp_ntz")
ROWS = [
    (5, "orders", "null_check", "o_custkey", "fail", "null_rate=2.00%, threshold=1.0%, null_count=2, total_rows=100", T0),
    (5, "orders", "freshness", None, "fail", "no successful pipeline run found for this table's source job", T0),
    (5, "items", "duplicate_check", "k", "warn", "x" * 120, T0),
    (5, "items", "referential_integrity", "o", "pass", "orphan_key_count=0", T0),
]


# Fixed value: the text that alert readers parse.
DIGEST = """Data Quality Alert -- 2 check(s) failing
Generated: 2024-01-31T09:30:00
============================================================

Table:      orders
Check type: freshness
Detail:     no successful pipeline run found for this table's source job
Blast radius: 2 table(s) potentially affected -- dim_date, fact
------------------------------------------------------------
Table:      orders
Check type: null_check
Column:     o_custkey
Detail:     null_rate=2.00%, threshold=1.0%, null_count=2, total_rows=100
Blast radius: 2 table(s) potentially affected -- dim_date, fact
------------------------------------------------------------

See the failure drill-down report for full detail."""


def test_digest_body_is_exact(spark):
    res = spark.createDataFrame(ROWS, SCHEMA)
    radius = spark.createDataFrame([("orders", "fact"), ("orders", "dim_date")], "failing_table string, affected_table string")
    got = failure_digest(res, radius, T0).first()
    assert got["body"] == DIGEST
    assert got["failing_count"] == 2


def test_report_lines_are_exact(spark):
    res = spark.createDataFrame(ROWS, SCHEMA)
    marker = {"pass": "pass", "warn": "WARN", "fail": "FAIL"}
    want = sorted(f"{marker[s]:4} {ct:22} {('[' + c + '] ') if c else ''}{d[:80]}" for _, _, ct, c, s, d, _ in ROWS)
    assert sorted(r["line"] for r in report_lines(res).collect()) == want
