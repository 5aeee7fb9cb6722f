"""Lineage edge tables: upsert, auto + override combination, nodes, roots and leaves.

Edge columns: job_name, source_table, target_table, source_type, detected_at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.operators.latest import latest_per_key

# Edge origins, in precedence order (a human-confirmed edge wins).
AUTO = "auto_parsed"
OVERRIDE = "manual_override"


def upsert_edges(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert new ``(job, source, target)`` edges; for an existing key only ``detected_at``
    is refreshed (the newest time wins, the first recorded ``source_type`` stays)."""
    cols = ["job_name", "source_table", "target_table", "source_type", "detected_at"]
    u = existing.select(*cols).unionByName(batch.select(*cols))
    first = F.min(F.struct(F.col("detected_at"), F.col("source_type")))  # ties broken by type: deterministic
    return u.groupBy("job_name", "source_table", "target_table").agg(
        first["source_type"].alias("source_type"),
        F.max("detected_at").alias("detected_at"),
    ).select(*cols)


def combine_edges(auto: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """One edge per ``(source_table, target_table)``: an override beats an auto-parsed edge,
    then the newest ``detected_at``, then the least job name."""
    cols = ["job_name", "source_table", "target_table", "detected_at"]
    u = auto.select(*cols, F.lit(AUTO).alias("source_type"))
    if overrides is not None:
        u = u.unionByName(overrides.select(*cols, F.lit(OVERRIDE).alias("source_type")))
    prec = F.when(F.col("source_type") == OVERRIDE, F.lit(1)).otherwise(F.lit(0))
    return latest_per_key(
        u, ["source_table", "target_table"], [prec.desc(), F.desc_nulls_last("detected_at"), F.asc("job_name")]
    ).select("source_table", "target_table", "job_name", "source_type", "detected_at")


def node_degrees(edges: DataFrame) -> DataFrame:
    """``(table_name, in_degree, out_degree, is_root, is_leaf)`` for every node."""
    ends = edges.select(
        F.explode(F.array(
            F.struct(F.col("source_table").alias("t"), F.lit(0).alias("i"), F.lit(1).alias("o")),
            F.struct(F.col("target_table").alias("t"), F.lit(1).alias("i"), F.lit(0).alias("o")),
        )).alias("e")
    ).select("e.*").where(F.col("t").isNotNull())
    g = ends.groupBy(F.col("t").alias("table_name")).agg(
        F.sum("i").cast("long").alias("in_degree"), F.sum("o").cast("long").alias("out_degree"))
    return g.select("table_name", "in_degree", "out_degree",
                    (F.col("in_degree") == 0).alias("is_root"), (F.col("out_degree") == 0).alias("is_leaf"))


def lineage_nodes(edges: DataFrame) -> DataFrame:
    return node_degrees(edges).select("table_name")
