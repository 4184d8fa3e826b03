"""Landing by need, partitions by size, files by instrument."""

import datetime as dt
import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barlens.plans import models, registry
from barlens.session import tasks_for
from barlens.sources import testdata

SF = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, tmp_path):
    """Two suppliers' lines: several a day, and rows that come twice."""
    lines = [(o, s, s, n, float(o % 3 + 1), 100.0 * o + n, dt.datetime(1999 + s % 2, 3, 1 + o % 20))
             for o in range(60) for s in (1, 2) for n in (1, 2)]
    spark.createDataFrame(lines + lines[:7], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, f"Supplier#{k}", 0, 5.0) for k in (1, 2)], "s_suppkey long, s_name string, s_nationkey int, "
                          "s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path), lines + lines[:7]


def test_universe_lands_no_bars(spark, tables):
    assert registry.q_universe(spark, tables[0]).count() >= 0
    assert set(testdata.landed_inputs(spark, tables[0]).stored) == {"screen", "assets"}


def test_bars_from_lines_by_hand(spark, tables):
    days = {}
    for o, p, s, n, q, x, day in tables[1]:
        days.setdefault((s, day.date()), []).append((o, n, p, q, x))
    made = testdata.bars_from_lineitem(spark.read.parquet(f"{tables[0]}/lineitem.parquet"))
    want = {k: (sum(int(r[3]) for r in v), *(Decimal(str(x)) for x in (min(r[4] for r in v), max(r[4] for r in v), min(v)[4], max(v)[4])))
            for k, v in days.items()}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert {(r[0], r[1]): tuple(r)[2:] for r in made.collect()} == want


def test_series_partitions_follow_the_size(spark, monkeypatch):
    """With small tasks both the series models and the hub are dealt into more partitions than the session says."""
    feeds = testdata.landed_inputs(spark, SF)
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks_for(feeds["current_daily"]) == base
    n = tasks_for(*[feeds[x] for x in testdata.FEEDS], task_bytes=5000)
    assert n > base
    monkeypatch.setattr(registry, "tasks_for", lambda *dfs: n)
    stock = registry.Inputs(spark, SF).stock(series=True)
    sma = models.sma_strategy(stock, 28.5)
    found = re.findall(r"Exchange hashpartitioning\((.*)\), (\w+)", sma._jdf.queryExecution().executedPlan().toString())
    assert any(what.startswith("pair_id") and f", {n}" in what and how == "REPARTITION_BY_NUM" for what, how in found)
    assert stock.orderBy("pair_id", "frequency", "transaction_date").collect() == \
        registry.Inputs(spark, SF).stock().orderBy("pair_id", "frequency", "transaction_date").collect()


def test_one_file_for_an_instrument(spark, tmp_path):
    raw = testdata.landed_inputs(spark, SF)["historical_daily"]
    assert raw.select("pair_id", F.year("row_date_timestamp")).distinct().count() > raw.select("pair_id").distinct().count()
    testdata.bar_documents(raw, 3).write.partitionBy("pair_id").text(f"{tmp_path}/docs")
    files = [[f for f in names if f.endswith(".txt")] for at, _, names in os.walk(f"{tmp_path}/docs") if "pair_id=" in at]
    assert files and all(len(f) == 1 for f in files)
    one, two = (testdata.bar_documents(raw, n).orderBy("pair_id", "value").collect() for n in (None, 3))
    assert one == two
