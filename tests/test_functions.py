import json
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st

from tablewatch.functions.scalar import fixed, humanize_seconds, iso_text, json_object_text, percent, py_list_text


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False), min_size=1, max_size=40))
def test_fixed_matches_python_format(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [(r["x"], r["a"], r["b"], r["c"]) for r in df.select("x", fixed("x", 2).alias("a"), fixed("x", 0).alias("b"),
                                                                 fixed("x", 1).alias("c")).collect()]
    for x, a, b, c in got:
        assert (a, b, c) == (f"{x:.2f}", f"{x:.0f}", f"{x:.1f}")


def test_tie_cases_round_half_even_on_binary_value(spark):
    xs = [0.125, 0.375, 2.675, 1.005, 99.995, 59.5, 2.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r[0] for r in df.select(fixed("x", 2)).collect()] == [f"{x:.2f}" for x in xs]


@settings(max_examples=5, deadline=None)
@given(st.dictionaries(st.text(min_size=1, max_size=6), st.text(max_size=6), min_size=0, max_size=5))
def test_json_text_matches_json_dumps(spark, d):
    d = {k: v for k, v in d.items() if k.isascii() and v.isascii() and k.isprintable() and v.isprintable()}
    df = spark.createDataFrame([([(k, v) for k, v in d.items()],)], "e array<struct<column_name:string,data_type:string>>")
    assert df.select(json_object_text("e")).first()[0] == json.dumps(d, sort_keys=True)


def test_list_iso_percent_humanize(spark):
    df = spark.createDataFrame([(["b", "a"], datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120), 0, 0)],
                               "l array<string>, t timestamp_ntz, u timestamp_ntz, n long, z long")
    r = df.select(py_list_text("l"), iso_text("t"), iso_text("u"), percent("n", "z")).first()
    assert r[0] == str(sorted(["b", "a"]))
    assert r[1] == datetime(2024, 1, 2, 3, 4, 5).isoformat()
    assert r[2] == datetime(2024, 1, 2, 3, 4, 5, 120).isoformat()
    assert r[3] == 0.0
    h = spark.createDataFrame([(59.4,), (60.0,), (3599.0,), (3600.0,)], "s double").select(humanize_seconds("s")).collect()
    assert [x[0] for x in h] == ["59 seconds", "1.0 minutes", "60.0 minutes", "1.00 hours"]


def test_percent_order_of_operations(spark):
    df = spark.createDataFrame([(1, 3)], "n long, t long")
    assert df.select(percent("n", "t")).first()[0] == 1 / 3 * 100
