"""Reachability over the lineage edge table: upstream, downstream, blast radius.

Closure for a *set* of start nodes at once, in a number of rounds that grows with the logarithm of the
depth. ``jump`` holds the pairs joined by a walk of exactly ``span`` edges, first the edges themselves. A round
joins the reached pairs with it, which reaches all nodes up to ``span`` edges further, drops pairs reached
earlier by a left-anti join on ``(root, node)``, keeps the least distance of each new pair (and with it the
lexicographically least path, since all parts of shortest paths are shortest and of fixed length), and is
checkpointed to the shared checkpoint folder. Then ``jump`` is joined with itself, so a
chain of 1,000 edges takes 10 rounds. Where that would cost more than it saves (its rows are counted before
they are made; hubs and dense cycles have very many walks) the span stays as it is and rounds go on with it.
The result is the same either way. Between the rounds a path is one text of its inner nodes (see ``_step``); the
ends are columns already. The loop ends when a round reaches nothing new, so cycles terminate; a start node is
never reported as its own descendant.

Per round the driver reads a few numbers. Everything else is distributed. A side of a join is broadcast, and so passes
through the driver, only while its rows have been measured as small (``SMALL``), whatever the planner takes their size for;
two larger sides are shuffled and merged. Skewed hubs in the joins are split by AQE's skew-join handling.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablewatch.session import cut_lineage


def _edge_pairs(edges: DataFrame, direction: str, src: str, dst: str) -> DataFrame:
    a, b = (src, dst) if direction == "down" else (dst, src)
    return (
        edges.select(F.col(a).alias("_from"), F.col(b).alias("_to"))
        .where(F.col("_from").isNotNull() & F.col("_to").isNotNull() & (F.col("_from") != F.col("_to")))
        .distinct()
    )


def nodes_of(edges: DataFrame, src: str = "source_table", dst: str = "target_table") -> DataFrame:
    return edges.select(F.col(src).alias("table_name")).union(edges.select(F.col(dst).alias("table_name"))).where(
        F.col("table_name").isNotNull()).distinct()


#: The span is doubled while the longer walks are at most so many times the edges and the reached pairs.
DOUBLING = 4
#: Nodes that may be broadcast, about 10 MB.
FEW = 100_000
#: Bytes of rows that may be broadcast; the driver holds some three times as many while it builds their table.
SMALL = 10 << 20


def _merged(df: DataFrame, size: int) -> DataFrame:
    """``df`` of ``size`` bytes as a side of a join, never broadcast if it is large. The planner takes a checkpoint for as
    large as the files its rows were derived from, which can be a tenth of its size in memory."""
    return df if size <= SMALL else df.hint("merge")


def _joined(x: DataFrame, x_size: int, y: DataFrame, y_size: int, on: Column) -> DataFrame:
    """Inner join of frames of so many bytes: the small side goes to the large one, two large ones are merged."""
    if x_size > SMALL >= y_size:
        return x.join(F.broadcast(y), on)
    if y_size > SMALL >= x_size:
        return F.broadcast(x).join(y, on)
    return _merged(x, x_size).join(y, on)


def _walks(jump: DataFrame, size: int) -> int:
    """Rows of ``jump`` of ``size`` bytes joined with itself, before pairs met by several walks are merged."""
    into = jump.groupBy(F.col("_to").alias("node")).agg(F.count("*").cast("double").alias("i"))
    from_ = jump.groupBy(F.col("_from").alias("node")).agg(F.count("*").cast("double").alias("o"))
    return int(into.join(_merged(from_, size), "node").agg(F.coalesce(F.sum(F.col("i") * F.col("o")), F.lit(0.0))).first()[0])


def _step(node: Column) -> Column:
    """A node's name as part of a path text: closed by NUL, with NUL and SOH inside names written so that texts
    of equally many nodes are ordered as the lists of their names."""
    return F.concat(F.replace(F.replace(node, F.lit("\1"), F.lit("\1\2")), F.lit("\0"), F.lit("\1\1")), F.lit("\0"))


def _nodes(inner: Column) -> Column:
    """The names of a path text."""
    back = lambda x: F.replace(F.replace(x, F.lit("\1\1"), F.lit("\0")), F.lit("\1\2"), F.lit("\1"))
    names = F.split(inner, "\\x00")
    return F.transform(F.slice(names, F.lit(1), F.size(names) - 1), back)


def _doubled(jump: DataFrame, size: int, with_paths: bool) -> DataFrame:
    """Pairs joined by a walk of twice the length of those in ``jump``, each with its least path."""
    y = jump.select(F.col("_from").alias("_mid"), F.col("_to").alias("_end"), *([F.col("_inner").alias("_rest")] if with_paths else []))
    both = jump.join(_merged(y, size), jump["_to"] == y["_mid"])
    if with_paths:
        # Dealt by the ends first: one sort of a bounded partition, not another one of all that a task has joined.
        walks = both.select("_from", F.col("_end").alias("_to"), F.concat("_inner", _step(F.col("_mid")), "_rest").alias("_inner"))
        return walks.repartition("_from", "_to").groupBy("_from", "_to").agg(F.min("_inner").alias("_inner"))
    return both.select("_from", F.col("_end").alias("_to")).distinct()


def _counted(df: DataFrame) -> tuple[DataFrame, int, int]:
    """``df`` cut from its lineage, its rows and their bytes, observed while the checkpoint job runs: no extra job."""
    obs = Observation(f"tw_round_{uuid.uuid4().hex}")
    names = [F.octet_length(c).cast("long") for c, kind in df.dtypes if kind == "string"]
    size = F.coalesce(F.sum(sum(names, F.lit(8 * (1 + len(df.columns) + len(names))))), F.lit(0))
    out = cut_lineage(df.observe(obs, F.count(F.lit(1)).alias("n"), size.alias("size")))
    return out, obs.get["n"], obs.get["size"]


def _walk_table(jump: DataFrame) -> tuple[DataFrame, int, int, int]:
    """``jump`` cut from its lineage, its rows, their bytes, and about how many nodes its walks set out from."""
    obs = Observation(f"tw_walks_{uuid.uuid4().hex}")
    out, n, size = _counted(jump.observe(obs, F.approx_count_distinct("_from").alias("n")))
    return out, n, size, obs.get["n"]


def reachable(
    edges: DataFrame,
    starts: DataFrame | None = None,
    direction: str = "down",
    with_paths: bool = False,
    src: str = "source_table",
    dst: str = "target_table",
    doubling: float = DOUBLING,
) -> DataFrame:
    """Pairs ``(root, node, distance[, path])`` for every node reachable from each root.

    ``starts``: DataFrame with column ``table_name`` (default: every node of the graph).
    ``direction``: ``down`` follows edges (descendants), ``up`` reverses them (ancestors).
    ``doubling``: how many times the edges and reached pairs longer walks may number; 0 goes edge by edge.
    Unknown start nodes simply reach nothing.
    """
    pairs = _edge_pairs(edges, direction, src, dst)
    jump, n_edges, jump_size, n_sources = _walk_table(pairs.withColumn("_inner", F.lit("")) if with_paths else pairs)
    if starts is None:
        starts = nodes_of(edges, src, dst)
    seeds = starts.select(F.col("table_name").alias("root")).where(F.col("root").isNotNull()).distinct()
    first = seeds.select("root", F.col("root").alias("node"), F.lit(0).alias("distance"), *([F.lit("").alias("inner")] if with_paths else []))
    seen, n_seen, size = _counted(first)
    parts: list[DataFrame] = []
    sizes = {0: size}  # bytes of the starts and of each part, by its least distance
    known = span = 1  # all pairs nearer than ``known`` are in ``seen``
    while True:
        # Longer walks from every reached pair find each new pair at its own distance or more: the least counts.
        near = seen.where(F.col("distance") >= known - span)
        if known > 1 and n_sources <= FEW:
            # Most nodes of a deep graph have no long walk before them: their pairs need no shuffle to find that out.
            near = near.join(F.broadcast(jump.select(F.col("_from").alias("node")).distinct()), "node", "left_semi")
        near_size = sum(size for least, size in sizes.items() if least >= known - span)
        step = _joined(near, near_size, jump, jump_size, near["node"] == jump["_from"])
        further = (F.col("distance") + span).alias("distance")
        known_pairs = _merged(seen.select("root", "node"), sum(sizes.values()))  # a sort-merge join can spill
        if with_paths:
            # Known pairs go before the paths are compared; the aggregate then needs no shuffle and no sort of its own.
            middle = F.when(F.col("distance") > 0, _step(F.col("node"))).otherwise(F.lit(""))
            step = step.select("root", F.col("_to").alias("node"), further, F.concat("inner", middle, "_inner").alias("inner"))
            step = step.join(known_pairs, ["root", "node"], "left_anti")
            step = step.groupBy("root", "node").agg(F.min(F.struct("distance", "inner")).alias("best")).select("root", "node", "best.*")
        else:
            step = step.select("root", F.col("_to").alias("node"), further).groupBy("root", "node").agg(F.min("distance").alias("distance"))
            step = step.join(known_pairs, ["root", "node"], "left_anti")
        step, n, size = _counted(step)
        if n == 0:
            break
        parts.append(step)
        sizes[known] = size
        seen = seen.unionByName(step)
        n_seen += n
        known += span
        if span * 2 == known and _walks(jump, jump_size) <= doubling * (n_edges + n_seen):
            jump, n_walks, jump_size, n_sources = _walk_table(_doubled(jump, jump_size, with_paths))
            span *= 2
            if n_walks == 0:  # no walk of ``known`` edges, so nothing is that far
                break
    out = parts[0] if parts else first.limit(0)
    for p in parts[1:]:
        out = out.unionByName(p)
    path = F.concat(F.array("root"), _nodes(F.col("inner")), F.array("node")) if with_paths else None
    return out.select("root", "node", "distance", *([path.alias("path")] if with_paths else []))


def downstream(edges: DataFrame, starts: DataFrame | None = None, **kw) -> DataFrame:
    """``(table_name, downstream_table, distance)``: all descendants, excluding the start."""
    r = reachable(edges, starts, "down", **kw)
    return r.select(F.col("root").alias("table_name"), F.col("node").alias("downstream_table"), "distance")


def upstream(edges: DataFrame, starts: DataFrame | None = None, down: DataFrame | None = None, **kw) -> DataFrame:
    """``(table_name, upstream_table, distance)``: all ancestors, excluding the start.

    ``down``: what ``downstream`` gave from every node; its pairs are then read from their other end, not walked again."""
    if down is not None:
        return down.select(F.col("downstream_table").alias("table_name"), F.col("table_name").alias("upstream_table"), "distance")
    r = reachable(edges, starts, "up", **kw)
    return r.select(F.col("root").alias("table_name"), F.col("node").alias("upstream_table"), "distance")


def blast_radius(edges: DataFrame, failing: DataFrame, **kw) -> DataFrame:
    """``(failing_table, affected_table, distance, path, path_text)`` for each failing table
    (column ``table_name``): every downstream table with one shortest path (least
    lexicographically among equals)."""
    r = reachable(edges, failing.select("table_name"), "down", with_paths=True, **kw)
    return r.select(
        F.col("root").alias("failing_table"),
        F.col("node").alias("affected_table"),
        "distance",
        "path",
        F.array_join("path", " -> ").alias("path_text"),
    )


def blast_radius_summary(failing: DataFrame, radius: DataFrame) -> DataFrame:
    """``(failing_table, affected_count)`` including failing tables with nothing downstream."""
    counts = radius.groupBy("failing_table").agg(F.count(F.lit(1)).alias("affected_count"))
    f = failing.select(F.col("table_name").alias("failing_table")).distinct()
    return f.join(counts, "failing_table", "left").select(
        "failing_table", F.coalesce("affected_count", F.lit(0)).cast("long").alias("affected_count"))
