"""What staged text, shuffles and intermediate tables leave on disk."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from barlens.plans import registry
from barlens.session import FREE_SHUFFLES, held
from barlens.sinks import STAGED, write_csv
from barlens.sources import testdata
from barlens.streaming.bars import live_bars

from helpers import raw_rows


def made(path, suffix=""):
    return [os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.endswith(suffix)]


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """Lines of 15 suppliers in the historical and the current span, some twice; scratch tables lie under ``scratch``."""
    lines = [(o, s, s, n, float(o % 3 + 1), 100.0 * o + n, dt.datetime(2001, 4 + o % 5, 1 + o % 20))
             for o in range(1, 40) for s in range(1, 16) for n in (1, 2)]
    spark.createDataFrame(lines + lines[:9], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    scratch = lambda _, name: f"{tmp_path}/scratch/{name}"
    monkeypatch.setattr(registry, "scratch_path", scratch)
    monkeypatch.setattr(testdata, "scratch_path", scratch)
    return str(tmp_path)


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def left(spark, before):
    """Shuffle files that are still there a while later (they go in the background)."""
    for _ in range(40):
        if not (more := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return more


def test_landing_corrupt_is_stored_compressed(spark, tables):
    before = shuffle_files(spark)
    found = registry.q_landing_corrupt(spark, tables)
    assert not left(spark, before)
    at = f"{tables}/scratch/corrupt-landing"
    for name in testdata.FEEDS:
        docs, lines = made(f"{at}/{name}/json"), made(f"{at}/{name}/csv", ".csv.gz")
        assert len([f for f in docs if f.endswith(".txt.gz")]) == 15 and lines
        assert not [f for f in docs if "/pair_id=" in f and not f.endswith(".txt.gz")]      # no file beside each
        assert not made(at, ".txt") and not made(at, ".csv")
    rows = {(r.kind, r.pair_id): r.n for r in found.collect()}
    feeds = testdata.landed_inputs(spark, tables)
    assert sum(n for (kind, _), n in rows.items() if kind == "read") == sum(feeds[f].count() for f in testdata.FEEDS)
    assert sorted(p for kind, p in rows if kind == "corrupt document") == [5, 10, 15]
    assert sorted(p for kind, p in rows if kind == "corrupt line") == [7, 14]


def test_bars_go_with_the_last_feed(spark, tables):
    feeds = testdata.Landing(spark, tables)
    assert feeds["historical_daily"].count() and feeds["current_daily"].count() and feeds["historical_weekly"].count()
    assert os.path.isdir(f"{feeds.base}/bars") and os.path.isdir(f"{feeds.base}/weekly")
    assert feeds["current_weekly"].count()
    assert sorted(os.listdir(feeds.base)) == sorted(feeds.stored) == sorted(testdata.FEEDS)
    assert all(feeds[name].count() for name in testdata.FEEDS)


def test_staged_csv_comes_back_and_ends_after_so_many_rows(spark, tmp_path):
    rows = spark.createDataFrame([(i, f'a "{i}", b') for i in range(100)], "k long, t string").coalesce(1)
    write_csv(rows, f"{tmp_path}/csv", **(STAGED | {"maxRecordsPerFile": 30}))
    assert len(made(f"{tmp_path}/csv", ".csv.gz")) == 4
    back = spark.read.schema("k long, t string").option("header", True).csv(f"{tmp_path}/csv")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_settings_come_back(spark):
    key = next(iter(FREE_SHUFFLES))
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), held(spark, FREE_SHUFFLES | {"spark.barlens.test": "1"}):
        assert spark.conf.get(key) == "true" and spark.conf.get("spark.barlens.test") == "1"
        1 // 0
    assert spark.conf.get(key) == before and spark.conf.get("spark.barlens.test", None) is None


@pytest.mark.parametrize("query, names, suffix", [("bar_landing", tuple(testdata.FEEDS), ".txt.gz"),
                                                  ("bar_csv_staged", ("historical_daily", "current_daily"), ".csv.gz")])
def test_folders_of_instruments_hold_one_compressed_file(spark, tables, query, names, suffix):
    before = shuffle_files(spark)
    found = registry.QUERIES[query](spark, tables)
    assert not left(spark, before)
    for name in names:
        files = [f for f in made(f"{tables}/scratch/{query.replace('_', '-')}/{name}") if "/pair_id=" in f]
        assert len(files) == 15 and all(f.endswith(suffix) for f in files), name
    feeds = testdata.landed_inputs(spark, tables)
    raw = [registry._typed_raw(feeds[name], name.split("_")[1]) for name in names]
    assert sorted(map(str, found.collect())) == sorted(str(r) for df in raw for r in df.select(*found.columns).collect())


def test_bar_csv_is_stored_compressed(spark, tables):
    before = shuffle_files(spark)
    found = registry.q_bar_csv(spark, tables)
    assert not left(spark, before)
    at = f"{tables}/scratch/bar-csv"
    assert made(at, ".csv.gz") and not made(at, ".csv")
    feeds = testdata.landed_inputs(spark, tables)
    raw = [registry._typed_raw(feeds[name], name.split("_")[1]) for name in testdata.FEEDS]
    assert sorted(map(str, found.collect())) == sorted(str(r) for df in raw for r in df.select(*found.columns).collect())


def test_first_load_of_a_live_table_is_its_base(spark, tmp_path):
    """The second load folds; only the month that it touches is written again, and replays change nothing."""
    from barlens.streaming import bars as S
    target, at = f"{tmp_path}/live", dt.datetime(2024, 6, 1)
    feed = lambda rows_: raw_rows(spark, rows_).withColumn("frequency", F.lit("daily"))
    first = feed([(k, dt.date(2024, m, d), f"{k}.{m}", at) for k in (1, 2) for m in (1, 2, 3) for d in (1, 1, 2)])
    again = feed([(1, dt.date(2024, 2, 1), "7.5", at), (1, dt.date(2024, 2, 2), "8.5", at - dt.timedelta(days=1))])
    load = S.upsert_latest(target, compact_every=2)
    load(first, 0)
    one = S.live_bars(spark, target).snapshot()
    assert sorted(one.base) == [f"daily-2024-0{m}" for m in (1, 2, 3)] and not one.deltas
    load(again, 1)
    for n, df in ((1, again), (0, first)):
        load(df, n)
    two = S.live_bars(spark, target).snapshot()
    assert not two.deltas and [p for p in two.base if two.base[p] != one.base[p]] == ["daily-2024-02"]
    rows = {(r.pair_id, r.transaction_date): float(r.last_close) for r in S.latest_view(spark, target).collect()}
    want = {(k, dt.date(2024, m, d)): float(f"{k}.{m}") for k in (1, 2) for m in (1, 2, 3) for d in (1, 2)}
    assert rows == want | {(1, dt.date(2024, 2, 1)): 7.5}


def test_an_empty_first_load_and_loads_that_are_not_merged(spark, tmp_path):
    from barlens.streaming import bars as S
    at = dt.datetime(2024, 6, 1)
    bar = raw_rows(spark, [(1, dt.date(2024, 1, 1), "5", at)]).withColumn("frequency", F.lit("daily"))
    load = S.upsert_latest(f"{tmp_path}/live", compact_every=2)
    for n, df in enumerate((bar.limit(0), bar, bar)):
        load(df, n)
    assert [float(r.last_close) for r in S.latest_view(spark, f"{tmp_path}/live").collect()] == [5.0]
    t = S.live_bars(spark, f"{tmp_path}/other")
    twice = S.latest_view(spark, f"{tmp_path}/live").withColumn("_batch", F.lit(0).cast("bigint"))
    assert t.upsert(twice.unionAll(twice), ("s", 0)) and t.latest().count() == 1        # rows of one key: merged when read


def test_stream_latest_keeps_no_folded_folder(spark, tables):
    before = shuffle_files(spark)
    found = registry.q_stream_latest(spark, tables)
    assert not left(spark, before)
    at = f"{tables}/scratch/bars-stream"
    snap = live_bars(spark, f"{at}/table").snapshot()
    assert set(os.listdir(f"{at}/table/data")) == {*snap.base.values(), *(f for f, _ in snap.deltas)}
    assert all(f.endswith(".zstd.parquet") for part in ("landing", "table") for f in made(f"{at}/{part}", ".parquet"))
    assert sorted(map(str, found.collect())) == sorted(map(str, registry.q_bars_latest(spark, tables).select(*found.columns).collect()))


def test_stream_redelivered_is_stored_compressed(spark, tables, monkeypatch):
    monkeypatch.setattr(registry, "FILE_ROWS", 90)
    before = shuffle_files(spark)
    found = registry.q_stream_redelivered(spark, tables)
    assert not left(spark, before)
    at = f"{tables}/scratch/redelivered"
    assert max(r.n for r in spark.read.parquet(f"{at}/landing").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) <= 90
    assert all(made(f"{at}/{part}", ".zstd.parquet") and all(f.endswith(".zstd.parquet") for f in made(f"{at}/{part}", ".parquet"))
               for part in ("landing", "out"))
    feeds = testdata.landed_inputs(spark, tables)
    raw = [registry._typed_raw(feeds[name], "daily") for name in ("historical_daily", "current_daily")]
    assert sorted(map(str, found.collect())) == sorted(str(r) for df in raw for r in df.select(*found.columns).collect())
