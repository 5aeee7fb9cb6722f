from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from tablewatch.operators.asof import asof_backward

BASE = datetime(2024, 1, 1)


def brute(left, right):
    out = {}
    for lid, key, t in left:
        cands = [rt for k, rt in right if k == key and t is not None and rt is not None and rt <= t]
        out[lid] = max(cands) if cands else None
    return out


times = st.one_of(st.none(), st.integers(0, 72 * 60).map(lambda m: BASE + timedelta(minutes=m)))


@settings(max_examples=15, deadline=None)
@given(
    left=st.lists(st.tuples(st.sampled_from(["a", "b", None]), times), max_size=25),
    right=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), times), max_size=25),
    bucket=st.sampled_from(["hour", "day"]),
    parts=st.sampled_from([1, 3, 7]),
)
def test_asof_matches_brute_force(spark, left, right, bucket, parts):
    lrows = [(i, k, t) for i, (k, t) in enumerate(left)]
    ldf = spark.createDataFrame(lrows, "lid int, k string, t timestamp_ntz")
    rdf = spark.createDataFrame(right, "k string, rt timestamp_ntz")
    want = brute(lrows, right)
    b = asof_backward(ldf, rdf, ["k"], "t", "rt", out="v", method="bucket", bucket=bucket)
    assert {r["lid"]: r["v"] for r in b.collect()} == want
    r = asof_backward(ldf, rdf, ["k"], "t", "rt", out="v", method="range", partitions=parts)
    assert {x["lid"]: x["v"] for x in r.collect()} == want


def test_range_method_splits_a_hot_key(spark):
    # one key holds every row: the range plan still spreads it over all partitions
    rows = [(i, "hot", BASE + timedelta(minutes=i)) for i in range(0, 400, 2)]
    ldf = spark.createDataFrame([(i, k, t + timedelta(minutes=1)) for i, k, t in rows], "lid int, k string, t timestamp_ntz")
    rdf = spark.createDataFrame([(k, t) for _, k, t in rows], "k string, rt timestamp_ntz")
    got = {r["lid"]: r["v"] for r in asof_backward(ldf, rdf, ["k"], "t", "rt", out="v", partitions=8).collect()}
    assert got == {i: t for i, _, t in rows}


def test_equal_time_is_inclusive_and_rows_are_kept(spark):
    ldf = spark.createDataFrame([(1, "a", BASE), (2, "a", BASE), (3, "z", BASE)], "lid int, k string, t timestamp_ntz")
    rdf = spark.createDataFrame([("a", BASE), ("a", BASE - timedelta(days=3))], "k string, rt timestamp_ntz")
    for method in ("range", "bucket"):
        got = {r["lid"]: r["v"] for r in asof_backward(ldf, rdf, ["k"], "t", "rt", out="v", method=method).collect()}
        assert got == {1: BASE, 2: BASE, 3: None}
