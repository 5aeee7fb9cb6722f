"""Metadata tables derived from the benchmark tables, deterministically and at scale.

The checks need run logs, lineage edges, check history and job scripts; the benchmark
data has none, so they are derived from it row by row (events -> runs and check results,
customer -> table/job map, part -> lineage DAG and script corpus). Every derivation is a
projection, so it grows with the data and is reproducible in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Evaluation time of the derived metadata and its edge batch times.
AS_OF = "2024-01-31 00:00:00"
EDGES_AT = "2024-01-02 00:00:00"
OVERRIDES_AT = "2024-01-03 00:00:00"
UPSERT_FIRST_AT = "2024-01-01 00:00:00"
UPSERT_SECOND_AT = "2024-01-05 00:00:00"
JOBS_AT = "2024-01-01 00:00:00"

# Check types.
CHECK_TYPES = ("null_check", "duplicate_check", "referential_integrity", "schema_drift", "freshness")

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _k(props="props"):
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


# --- runs ----------------------------------------------------------------------------------

def _run_status():
    eid = F.col("event_id")
    return F.when(eid % 97 == 1, F.lit("running")).when(eid % 10 == 0, F.lit("failed")).otherwise(F.lit("success"))


def fx_runs(events: DataFrame) -> DataFrame:
    """Current-state run rows, one per event."""
    st = _run_status()
    done = st != "running"
    return events.select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("job_name"),
        (F.col("ts") - F.expr("INTERVAL 20 SECONDS")).alias("started_at"),
        F.when(done, F.col("ts")).alias("finished_at"),
        st.alias("status"),
        F.when(done, _k()).alias("rows_read"),
        F.when(st == "success", _k()).alias("rows_written"),
        F.when(done, F.lit(20).cast("decimal(10,2)")).alias("duration_seconds"),
        F.when(st == "failed", F.lit("injected failure")).alias("error_message"),
    )


def fx_run_events(events: DataFrame) -> DataFrame:
    """The same runs as an append-only event log: a start event per run plus a terminal
    event for every run that finished."""
    st = _run_status()
    job = F.concat(F.lit("job_"), F.col("user_id").cast("string"))
    start = events.select(
        F.col("event_id").alias("run_id"), job.alias("job_name"),
        (F.col("ts") - F.expr("INTERVAL 20 SECONDS")).alias("event_time"), F.lit("running").alias("status"),
        F.lit(None).cast("bigint").alias("rows_read"), F.lit(None).cast("bigint").alias("rows_written"),
        F.lit(None).cast("string").alias("error_message"))
    end = events.where(st != "running").select(
        F.col("event_id").alias("run_id"), job.alias("job_name"), F.col("ts").alias("event_time"), st.alias("status"),
        _k().alias("rows_read"), F.when(st == "success", _k()).alias("rows_written"),
        F.when(st == "failed", F.lit("injected failure")).alias("error_message"))
    return start.unionByName(end)


# --- table -> job map, check results -----------------------------------------------------------

def fx_job_edges(customer: DataFrame) -> DataFrame:
    """Producing job of ``tbl_<c>`` is ``job_<c>``, except for c % 7 = 3 (no producing job)."""
    c = F.col("c_custkey").cast("string")
    return customer.where(F.col("c_custkey") % 7 != 3).select(
        F.concat(F.lit("job_"), c).alias("job_name"),
        F.concat(F.lit("src_"), c).alias("source_table"),
        F.concat(F.lit("tbl_"), c).alias("target_table"),
        F.lit("auto_parsed").alias("source_type"),
        _ntz(JOBS_AT).alias("detected_at"))


def fx_checked_tables(customer: DataFrame) -> DataFrame:
    return customer.select(F.concat(F.lit("tbl_"), F.col("c_custkey").cast("string")).alias("table_name"))


def fx_results(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    ctype = F.element_at(F.array(*[F.lit(t) for t in CHECK_TYPES]), (eid % 5 + 1).cast("int"))
    return events.select(
        eid.alias("check_result_id"),
        F.floor(eid / 50).cast("bigint").alias("run_id"),
        F.concat(F.lit("tbl_"), F.col("user_id").cast("string")).alias("table_name"),
        ctype.alias("check_type"),
        F.when(eid % 5 == 0, F.concat(F.lit("c"), (eid % 3).cast("string"))).alias("column_name"),
        F.when(eid % 11 == 0, F.lit("fail")).when(eid % 11 == 1, F.lit("warn")).otherwise(F.lit("pass")).alias("status"),
        F.concat(F.lit("k="), F.get_json_object(F.col("props"), "$.k")).alias("detail"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("checked_at"),
    )


def fx_drift_results(events: DataFrame) -> DataFrame:
    """Check history whose drift rows embed schema snapshots (both detail shapes)."""
    r = fx_results(events)
    eid = F.col("check_result_id")
    k = F.regexp_replace(F.col("detail"), "^k=", "")
    js = F.concat(F.lit('{"k": "'), k, F.lit('", "user": "bigint"}'))
    det = F.when(eid % 2 == 0, F.concat(F.lit("no prior snapshot -- recording baseline: "), js)).otherwise(
        F.concat(F.lit("added columns: ['k'] | current_schema: "), js))
    return r.withColumn("detail", F.when(F.col("check_type") == "schema_drift", det).otherwise(F.col("detail")))


# --- lineage DAG over part --------------------------------------------------------------------

def _edge(src, dst, source_type: str, at: str):
    return F.struct(
        F.concat(F.lit("job_"), dst.cast("string")).alias("job_name"),
        F.concat(F.lit("tbl_"), src.cast("string")).alias("source_table"),
        F.concat(F.lit("tbl_"), dst.cast("string")).alias("target_table"),
        F.lit(source_type).alias("source_type"),
        _ntz(at).alias("detected_at"))


def fx_edges(part: DataFrame, at: str = EDGES_AT) -> DataFrame:
    """``p div 3 -> p`` for every part, plus ``p div 2 -> p`` when p % 5 = 0."""
    p = F.col("p_partkey")
    arr = F.array_compact(F.array(
        _edge(F.floor(p / 3), p, "auto_parsed", at),
        F.when(p % 5 == 0, _edge(F.floor(p / 2), p, "auto_parsed", at)),
    ))
    e = part.where(p > 0).select(F.explode(arr).alias("e")).select("e.*")
    return e.where(F.col("source_table") != F.col("target_table")).dropDuplicates(["source_table", "target_table"])


def fx_overrides(part: DataFrame) -> DataFrame:
    """Manual edges for p % 50 = 0: the existing pairs again plus a new ``p -> p+1`` pair."""
    p = F.col("p_partkey")
    arr = F.array(
        _edge(F.floor(p / 3), p, "manual_override", OVERRIDES_AT),
        _edge(F.floor(p / 2), p, "manual_override", OVERRIDES_AT),
        _edge(p, p + 1, "manual_override", OVERRIDES_AT),
    )
    return part.where((p > 0) & (p % 50 == 0)).select(F.explode(arr).alias("e")).select("e.*")


def fx_upsert_batches(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First batch: even parts; second batch: all parts, later, a third of them typed as
    manual overrides."""
    first = fx_edges(part.where(F.col("p_partkey") % 2 == 0), UPSERT_FIRST_AT)
    second = fx_edges(part, UPSERT_SECOND_AT)
    tgt = F.regexp_extract(F.col("target_table"), r"(\d+)$", 1).cast("bigint")
    second = second.withColumn("source_type", F.when(tgt % 3 == 0, F.lit("manual_override")).otherwise(F.col("source_type")))
    return first, second


# --- job script corpus --------------------------------------------------------------------------

# The six script shapes of the corpus, by part key % 6 (%1$d = part key).
SCRIPT_TEMPLATES = (
    'SOURCE_TABLE = "src_%1$d"\nTARGET_TABLE = "tgt_%1$d"\n\n\ndef run():\n'
    '    df = spark.read.table(SOURCE_TABLE)\n    out = df.filter(df.amount > 0)\n'
    '    out.write.mode("overwrite").saveAsTable(TARGET_TABLE)\n',
    'def run():\n    a = spark.read.table("a_%1$d")\n    b = spark.table("b_%1$d")\n'
    '    joined = a.join(b, on="id", how="inner")\n    joined.write.mode("overwrite").saveAsTable("fact_%1$d")\n',
    'def run():\n    raw = spark.read.csv("data/raw_%1$d.csv", header=True)\n'
    '    raw.select("a").write.saveAsTable("left_%1$d")\n    raw.select("b").write.saveAsTable("right_%1$d")\n',
    'def run():\n    name = "src"\n    df = spark.read.table(f"{name}_%1$d")\n    df.write.saveAsTable("out_%1$d")\n',
    'def run():\n    df = spark.read.table("in_%1$d")\n    suffix = "x"\n    df.write.saveAsTable(f"out_%1$d_{suffix}")\n',
    'def run():\n    try:\n        with open("cfg_%1$d") as fh:\n            df = spark.read.table("base_%1$d")\n'
    '        if fh:\n            df.write.saveAsTable("first_%1$d")\n        df = "not a frame"\n'
    '        df.write.saveAsTable("second_%1$d")\n    finally:\n        pass\n',
)


def fx_scripts(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    texts = F.array(*[F.format_string(t, p) for t in SCRIPT_TEMPLATES])
    return part.select(
        F.concat(F.lit("job_"), p.cast("string")).alias("job_name"),
        F.element_at(texts, (p % 6 + 1).cast("int")).alias("script_text"),
    )


def fx_script_files(supplier: DataFrame) -> DataFrame:
    """Statements of script files (folder, job, value): one script per team and one in its archive, with a load for
    each supplier of the team. File names are equal in all folders, and folders have blanks in their names."""
    s, team = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    kinds = supplier.withColumn("kind", F.explode(F.array(F.lit("stg"), F.lit("old"))))
    value = F.format_string('rows_%s = spark.read.table("raw_%s")\nrows_%s.write.saveAsTable("%s_%s")', s, s, s, F.col("kind"), s)
    folder = F.concat(F.when(F.col("kind") == "old", F.lit("archive of ")).otherwise(F.lit("")), F.lit("team "), team)
    return kinds.select(folder.alias("folder"), F.lit("all loads").alias("job"), value.alias("value"))


# --- faults --------------------------------------------------------------------------------------

def fx_fault_lineitem(lineitem: DataFrame) -> DataFrame:
    """l_partkey NULL where l_orderkey % 7 = 0 (fails), l_tax NULL where % 500 = 0 (passes)."""
    k = F.col("l_orderkey")
    return lineitem.withColumns({
        "l_partkey": F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("l_partkey")),
        "l_tax": F.when(k % 500 == 0, F.lit(None)).otherwise(F.col("l_tax")),
    })


def fx_active_customers(customer: DataFrame) -> DataFrame:
    """Parent side with keys c % 11 = 0 removed (their orders become orphans)."""
    return customer.where(F.col("c_custkey") % 11 != 0)
