"""Every catalog query against its DuckDB oracle (smallest tables by default;
``STRATA_ORACLE_SF=/root/testdata/sf0.01`` runs it at the driver's scale)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = os.environ.get("STRATA_ORACLE_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle")
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(rows, df.columns) == _bag(drows, dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "line"]
    assert df.count() >= 0
