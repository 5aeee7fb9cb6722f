"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import decimal
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
              "labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    for f in sdf.schema.fields:
        t = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(t, t.upper()) == dtypes[f.name], (f.name, t, dtypes[f.name])
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(dcols, cur.fetchall())


def test_every_table_query_has_an_oracle():
    assert set(E.registered.QUERIES) == set(E.registered.ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_an_absent_package_costs_the_corpus_queries_alone():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as E; assert len(E.queries()) == len(E.registered.QUERIES)"
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=os.path.dirname(E.__file__), check=True)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "status" in df.columns
