"""Differential check: every registered query against its DuckDB oracle on
the sf0.001 tables (row count, column names, exact order-insensitive values)."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__
from barlens.plans import registry as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "\0"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted("|".join(_norm(r[c]) for c in cols) for r in (x.asDict() for x in df.collect()))
    res = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted("|".join(_norm(dict(zip(names, r))[c]) for c in cols) for r in res.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_an_oracle():
    assert set(E.queries()) == set(E.oracle_sql())


def test_entry_runs(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert "profit_or_loss" in df.columns
