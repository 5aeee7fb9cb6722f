from collections import deque
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewatch.operators.edges import combine_edges, node_degrees, upsert_edges
from tablewatch.operators import graph
from tablewatch.operators.graph import blast_radius, downstream, reachable, upstream


def edges_df(spark, pairs):
    return spark.createDataFrame([(s, t) for s, t in pairs], "source_table string, target_table string")


def bfs(pairs, start):
    adj = {}
    for s, t in pairs:
        if s != t:
            adj.setdefault(s, set()).add(t)
    dist, q = {start: 0}, deque([start])
    while q:
        u = q.popleft()
        for v in adj.get(u, ()):
            if v not in dist:
                dist[v] = dist[u] + 1
                q.append(v)
    dist.pop(start)
    return dist


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcdefg"), st.sampled_from("abcdefg")), max_size=14))
def test_downstream_matches_bfs_with_cycles_and_self_loops(spark, pairs):
    e = edges_df(spark, pairs)
    got = {}
    for r in downstream(e).collect():
        got.setdefault(r["table_name"], {})[r["downstream_table"]] = r["distance"]
    nodes = {x for p in pairs for x in p}
    want = {n: bfs(pairs, n) for n in nodes}
    assert {k: v for k, v in want.items() if v} == got


def test_upstream_and_unknown_node(spark):
    e = edges_df(spark, [("a", "b"), ("b", "c"), ("x", "c")])
    starts = spark.createDataFrame([("c",), ("nope",)], "table_name string")
    up = {(r["table_name"], r["upstream_table"], r["distance"]) for r in upstream(e, starts).collect()}
    assert up == {("c", "b", 1), ("c", "x", 1), ("c", "a", 2)}


def test_blast_radius_least_shortest_path(spark):
    e = edges_df(spark, [("f", "b"), ("f", "a"), ("a", "z"), ("b", "z"), ("z", "f")])
    starts = spark.createDataFrame([("f",)], "table_name string")
    got = {r["affected_table"]: (r["distance"], r["path_text"]) for r in blast_radius(e, starts).collect()}
    assert got == {"a": (1, "f -> a"), "b": (1, "f -> b"), "z": (2, "f -> a -> z")}


def test_golden_star_schema_blast_radius(spark):
    pairs = [("data/c.csv", "stg_customers"), ("data/o.csv", "stg_orders"), ("data/i.csv", "stg_order_items"),
             ("data/p.csv", "stg_products"), ("data/s.csv", "stg_sellers"), ("stg_customers", "Dim_Customer"),
             ("stg_products", "Dim_Product"), ("stg_sellers", "Dim_Seller"), ("stg_orders", "Dim_Date"),
             ("stg_order_items", "Fact_Order_Items"), ("stg_orders", "Fact_Order_Items")]
    e = edges_df(spark, pairs)
    starts = spark.createDataFrame([("Dim_Customer",), ("stg_orders",)], "table_name string")
    got = {}
    for r in blast_radius(e, starts).collect():
        got.setdefault(r["failing_table"], set()).add(r["affected_table"])
    assert got == {"stg_orders": {"Dim_Date", "Fact_Order_Items"}}


def test_degrees_roots_leaves(spark):
    e = edges_df(spark, [("a", "b"), ("b", "c")])
    d = {r["table_name"]: (r["is_root"], r["is_leaf"]) for r in node_degrees(e).collect()}
    assert d == {"a": (True, False), "b": (False, False), "c": (False, True)}


def test_override_wins_and_upsert_refreshes(spark):
    from datetime import datetime
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    schema = "job_name string, source_table string, target_table string, source_type string, detected_at timestamp_ntz"
    auto = spark.createDataFrame([("j1", "a", "b", "auto_parsed", t2), ("j2", "a", "b", "auto_parsed", t1)], schema)
    over = spark.createDataFrame([("j9", "a", "b", "manual_override", t1)], schema)
    c = combine_edges(auto, over).collect()
    assert len(c) == 1 and c[0]["job_name"] == "j9" and c[0]["source_type"] == "manual_override"
    c2 = combine_edges(auto).collect()
    assert c2[0]["job_name"] == "j1"
    u = upsert_edges(auto.where("job_name = 'j2'"), spark.createDataFrame([("j2", "a", "b", "manual_override", t2)], schema))
    r = u.collect()
    assert len(r) == 1 and r[0]["detected_at"] == t2 and r[0]["source_type"] == "auto_parsed"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 11), st.integers(0, 11)), max_size=30), st.sampled_from([0, 0.5, 4, 1e9]))
def test_closure_is_the_same_however_far_spans_are_doubled(spark, pairs, doubling):
    names = [(f"t{a:02}", f"t{b:02}") for a, b in pairs]
    adj = {}
    for a, b in names:
        if a != b:
            adj.setdefault(a, set()).add(b)

    def least(start):  # least shortest paths, level by level
        best, level = {start: [start]}, {start: [start]}
        while level:
            new = {}
            for node, path in level.items():
                for t in adj.get(node, ()):
                    if t not in best and (t not in new or path + [t] < new[t]):
                        new[t] = path + [t]
            best |= new
            level = new
        return best

    got = {(r["root"], r["node"]): (r["distance"], r["path"]) for r in reachable(edges_df(spark, names), with_paths=True, doubling=doubling).collect()}
    want = {(n, t): (len(p) - 1, p) for n in {x for p in names for x in p} for t, p in least(n).items() if t != n}
    assert got == want


def test_chain_of_a_thousand_takes_about_ten_rounds(spark):
    rounds = []
    counted = graph._counted
    graph._counted = lambda df: rounds.append(1) or counted(df)
    try:
        pairs = [(f"c{i:04}", f"c{i + 1:04}") for i in range(1000)] + [(f"c{i:04}", f"c{i:04}x") for i in range(0, 1000, 50)]
        starts = spark.createDataFrame([("c0000",), ("c0700",)], "table_name string")
        got = {(r["root"], r["node"]): r["distance"] for r in reachable(edges_df(spark, pairs), starts).collect()}
    finally:
        graph._counted = counted
    assert got == {(f"c{s:04}", t): d for s in (0, 700) for t, d in bfs(pairs, f"c{s:04}").items()}
    assert len(rounds) <= 26  # two inputs, then at most two tables a round


def recorded(run):
    """What ``run`` materialises, and its result."""
    seen, counted = [], graph._counted
    graph._counted = lambda df: seen.append(df) or counted(df)
    try:
        return seen, run()
    finally:
        graph._counted = counted


def test_known_pairs_go_before_paths_are_compared(spark):
    e = edges_df(spark, [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")])
    made, out = recorded(lambda: reachable(e, with_paths=True))
    assert out.where("root = 'a' and node = 'd'").first()["path"] == ["a", "c", "d"]
    steps = [df._jdf.queryExecution().executedPlan().toString() for df in made if "distance" in df.columns][1:]
    assert steps
    for plan in steps:  # the aggregate stands above the anti join, and sorts nothing itself
        top = plan.split("== Initial Plan ==")[-1]
        assert top.index("SortAggregate") < top.index("LeftAnti")


def test_distances_alone_need_no_sorted_aggregate(spark):
    made, _ = recorded(lambda: reachable(edges_df(spark, [("a", "b"), ("b", "c"), ("a", "c")])))
    assert not [df for df in made if "SortAggregate" in df._jdf.queryExecution().executedPlan().toString()]


def test_no_round_once_no_walk_is_long_enough(spark):
    made, out = recorded(lambda: reachable(edges_df(spark, [("hub", f"t{i}") for i in range(5)])))
    assert out.count() == 5
    assert sum("distance" in df.columns for df in made) == 2  # the starts and one round


def test_the_same_pairs_with_many_or_few_nodes_to_go_on_from(spark):
    pairs = [(f"n{i // 3}", f"n{i}") for i in range(1, 60)] + [(f"n{i}", f"n{i + 1}") for i in range(0, 55, 5)]
    rows = lambda: sorted((r["root"], r["node"], r["distance"], r["path"]) for r in reachable(edges_df(spark, pairs), with_paths=True).collect())
    some, graph.FEW = graph.FEW, 0
    try:
        want = rows()
    finally:
        graph.FEW = some
    assert rows() == want


def test_paths_with_control_characters_in_names(spark):
    odd = ["\0", "\1", "\2", "\1\1", "\1\2", "\0\1", "", "a\0", "a", "a\1b"]
    pairs = [("root", m) for m in odd] + [(m, "end") for m in odd] + [("end", m + "x") for m in odd]
    got = {r["node"]: r["path"] for r in reachable(edges_df(spark, pairs), spark.createDataFrame([("root",)], "table_name string"), with_paths=True).collect()}
    assert got["end"] == ["root", "", "end"]
    assert all(got[m + "x"] == ["root", "", "end", m + "x"] for m in odd if m + "x" not in odd)
    for m in odd:
        one = reachable(edges_df(spark, [("r", m), (m, "s"), ("s", "t")]), with_paths=True).where("root = 'r' and node = 't'").first()
        assert one["path"] == ["r", m, "s", "t"]


def joins(frames):
    """The join lines of each plan that has any."""
    plans = [df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1] for df in frames]
    found = [[line for line in plan.splitlines() if "Join" in line] for plan in plans]
    return [lines for lines in found if lines]


def grid(spark, tmp_path):
    """Edges from a few kB of files, all of three levels, and their pairs."""
    spark.range(1, 400).write.parquet(f"{tmp_path}/ids")
    i = F.col("id")
    name = lambda c: F.concat(F.lit("table_"), c.cast("string"))
    edges = spark.read.parquet(f"{tmp_path}/ids").select(name(F.floor(i / 20)).alias("source_table"), name(i).alias("target_table"))
    pairs = [(f"table_{k // 20}", f"table_{k}") for k in range(1, 400)]
    return edges, pairs


def test_large_sides_of_a_round_are_never_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(graph, "SMALL", 1000, raising=False)
    monkeypatch.setattr(graph, "FEW", 0)
    edges, pairs = grid(spark, tmp_path)
    made, out = recorded(lambda: reachable(edges))
    assert joins(made) and not [line for lines in joins(made) for line in lines if "Broadcast" in line]
    assert {(r["root"], r["node"], r["distance"]) for r in out.collect()} == {(n, t, d) for n in {x for p in pairs for x in p} for t, d in bfs(pairs, n).items()}


def test_few_starts_go_to_a_large_graph(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(graph, "SMALL", 1000, raising=False)
    monkeypatch.setattr(graph, "FEW", 0)
    edges, pairs = grid(spark, tmp_path)
    starts = spark.createDataFrame([("table_0",), ("table_3",), ("nope",)], "table_name string")
    made, out = recorded(lambda: reachable(edges, starts))
    first = [line for line in joins(made)[0] if "Inner" in line]
    assert len(first) == 1 and "BroadcastHashJoin" in first[0] and "BuildLeft" in first[0]
    assert {(r["root"], r["node"], r["distance"]) for r in out.collect()} == {(n, t, d) for n in ("table_0", "table_3") for t, d in bfs(pairs, n).items()}


def test_rounds_count_rows_and_their_bytes(spark):
    names = ["a", "tabelle_größe", "表"]
    _, n, size = graph._counted(spark.createDataFrame([(x, 1) for x in names], "node string, distance int"))
    assert n == 3 and size == sum(len(x.encode()) + 8 * 4 for x in names)
    assert graph._counted(spark.createDataFrame([], "node string"))[1:] == (0, 0)


def test_drilldown_of_every_node_broadcasts_no_closure(spark, tmp_path, monkeypatch):
    from tablewatch.plans.reports import table_drilldown

    monkeypatch.setattr(graph, "SMALL", 1000, raising=False)
    monkeypatch.setattr(graph, "FEW", 0)
    edges, pairs = grid(spark, tmp_path)
    results = spark.createDataFrame([("table_0", "freshness", "fail", datetime(2024, 1, 1))], "table_name string, check_type string, status string, checked_at timestamp_ntz")
    made, out = recorded(lambda: table_drilldown(edges, results))
    assert joins(made) and not [line for lines in joins(made) for line in lines if "Broadcast" in line]
    got = {r["table_name"]: (r["n_upstream"], r["n_downstream"], r["status"]) for r in out.collect()}
    down = {n: set(bfs(pairs, n)) for n in {x for p in pairs for x in p}}
    assert got == {n: (sum(n in d for d in down.values()), len(down[n]), "fail" if n == "table_0" else "not checked") for n in down}
