"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is one join of the edges with the least neighbour of every node, written to the
checkpoint folder; two numbers per round come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.session import cut_lineage


def _star(edges: DataFrame) -> DataFrame:
    """edges (u, v): every v with the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link.

    Null ends, loops and repeated links change nothing; no links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where((F.col("u") != F.col("v")) & F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.where(F.col("u") != F.col("v")).distinct())
        small = _star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = cut_lineage(small.where(F.col("u") != F.col("v")).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
