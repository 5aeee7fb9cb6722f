"""Failure digest: one alert text per run with failing checks (``warn`` never alerts).

``digest_lines`` gives the alert as rows, one a line, numbered without gathering a run anywhere: block 0 is the
head, one block per failing check follows, with a line for every affected table, then the foot. ``failure_digest``
assembles one text per run for reports of a size that is mailed: all blocks of a run meet in one group there.
A run without failures produces no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.messages import (
    DIGEST_BLAST,
    DIGEST_CHECK,
    DIGEST_COLUMN,
    DIGEST_DETAIL,
    DIGEST_GENERATED,
    DIGEST_HEADER,
    DIGEST_HEAVY_RULE,
    DIGEST_LIGHT_RULE,
    DIGEST_NO_BLAST,
    DIGEST_SUBJECT,
    DIGEST_TABLE,
    render,
)
from tablewatch.functions.scalar import iso_text, utc_now
from tablewatch.operators.freshness import ts_lit
from tablewatch.operators.numbering import numbered

FOOTER = "See the failure drill-down report for full detail."


def failure_digest(results: DataFrame, radius: DataFrame | None = None, generated_at=None) -> DataFrame:
    """``results``: run_id, table_name, check_type, column_name, status, detail.
    ``radius``: failing_table, affected_table (from ``graph.blast_radius``).
    Returns run_id, failing_count, subject, body."""
    fails = results.where(F.col("status") == "fail").select("run_id", "table_name", "check_type", "column_name", "detail")
    if radius is not None:
        per_table = radius.groupBy(F.col("failing_table").alias("table_name")).agg(
            F.count(F.lit(1)).alias("n_affected"),
            F.array_join(F.array_sort(F.collect_list("affected_table")), ", ").alias("affected"),
        )
        fails = fails.join(per_table, "table_name", "left")
    else:
        fails = fails.withColumn("n_affected", F.lit(None).cast("long")).withColumn("affected", F.lit(None).cast("string"))
    blast = F.when(F.col("n_affected") > 0, render(
        DIGEST_BLAST, n=F.col("n_affected").cast("string"), tables=F.col("affected"))).otherwise(F.lit(DIGEST_NO_BLAST))
    block = F.concat_ws(
        "\n",
        render(DIGEST_TABLE, v=F.col("table_name")),
        render(DIGEST_CHECK, v=F.col("check_type")),
        F.when(F.col("column_name").isNotNull() & (F.col("column_name") != ""), render(DIGEST_COLUMN, v=F.col("column_name"))),
        render(DIGEST_DETAIL, v=F.coalesce(F.col("detail"), F.lit("None"))),
        blast,
        F.lit(DIGEST_LIGHT_RULE),
    )
    key = F.struct(F.col("table_name"), F.col("check_type"), F.coalesce(F.col("column_name"), F.lit("")).alias("c"),
                   F.coalesce(F.col("detail"), F.lit("")).alias("d"), block.alias("block"))
    g = fails.groupBy("run_id").agg(F.count(F.lit(1)).alias("failing_count"), F.array_sort(F.collect_list(key)).alias("blocks"))
    now = utc_now() if generated_at is None else ts_lit(generated_at)
    gen = iso_text(F.date_trunc("second", now).cast("timestamp_ntz"))
    n = F.col("failing_count").cast("string")
    body = F.concat_ws(
        "\n",
        render(DIGEST_HEADER, n=n),
        render(DIGEST_GENERATED, at=gen),
        F.lit(DIGEST_HEAVY_RULE),
        F.lit(""),
        F.array_join(F.transform("blocks", lambda b: b["block"]), "\n"),
        F.lit(""),
        F.lit(FOOTER),
    )
    return g.select("run_id", "failing_count",
                    render(DIGEST_SUBJECT, n=n).alias("subject"), body.alias("body"))


def _lines(*lines) -> F.Column:
    """(line_no, line) of consecutive lines; a NULL is left out and takes no number."""
    kept = F.array_compact(F.array(*lines))
    return F.inline(F.transform(kept, lambda line, i: F.struct((i + 1).cast("long").alias("line_no"), line.alias("line"))))


def digest_lines(results: DataFrame, radius: DataFrame, generated_at=None) -> DataFrame:
    """``(run_id, block_no, line_no, line)``; inputs as for ``failure_digest``.

    Blocks are in the order of table, check type, column and detail, affected tables in the order of their names.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    fails = results.where(F.col("status") == "fail").select("run_id", "table_name", "check_type", blank("column_name").alias("column_name"), "detail")
    blocks = numbered(fails.withColumn("d", blank("detail")), ["run_id"], ["table_name", "check_type", "column_name", "d"], "block_no")
    names = numbered(radius.select(F.col("failing_table").alias("table_name"), "affected_table"), ["table_name"], ["affected_table"], "name_no")
    blocks = blocks.join(names.groupBy("table_name").agg(F.count("*").alias("n")), "table_name", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    has_column = F.col("column_name") != ""
    top = F.lit(4) + has_column.cast("int")  # lines of a block before the names
    count = F.col("n").cast("string")
    fixed = blocks.select("run_id", "block_no", _lines(
        render(DIGEST_TABLE, v=F.col("table_name")),
        render(DIGEST_CHECK, v=F.col("check_type")),
        F.when(has_column, render(DIGEST_COLUMN, v=F.col("column_name"))),
        render(DIGEST_DETAIL, v=F.coalesce("detail", F.lit("None"))),
        F.when(F.col("n") > 0, F.rtrim(render(DIGEST_BLAST, n=count, tables=""))).otherwise(DIGEST_NO_BLAST),
    ))
    named = blocks.join(names, "table_name").select("run_id", "block_no", (top + F.col("name_no")).alias("line_no"), F.concat(F.lit("  "), "affected_table").alias("line"))
    rule = blocks.select("run_id", "block_no", (top + F.col("n") + 1).alias("line_no"), F.lit(DIGEST_LIGHT_RULE).alias("line"))
    runs = blocks.groupBy("run_id").agg(F.count("*").alias("blocks"))
    now = utc_now() if generated_at is None else ts_lit(generated_at)
    at = iso_text(F.date_trunc("second", now).cast("timestamp_ntz"))
    head = runs.select("run_id", F.lit(0).cast("long").alias("block_no"), _lines(
        render(DIGEST_HEADER, n=F.col("blocks").cast("string")), render(DIGEST_GENERATED, at=at), F.lit(DIGEST_HEAVY_RULE), F.lit("")))
    foot = runs.select("run_id", (F.col("blocks") + 1).alias("block_no"), _lines(F.lit(""), F.lit(FOOTER)))
    out = head
    for part in (fixed, named, rule, foot):
        out = out.unionByName(part)
    return out.select("run_id", "block_no", "line_no", "line")
