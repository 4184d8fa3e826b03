"""Shuffles and partitions of the unified bars."""

import datetime as dt
import re

from barlens.operators.bars import unify_bars
from barlens.plans import registry
from barlens.session import TASK_BYTES

from helpers import assets, days, empty_raw, raw_rows

SF = "/root/testdata/sf0.001"
T = dt.datetime(2024, 2, 1)


def shuffles_of_bars(df):
    p = df._jdf.queryExecution().executedPlan().toString()
    return [e for e in re.findall(r"Exchange hashpartitioning\((.*)", p) if "REPARTITION" in e or "transaction_date" in e]


def test_bars_are_shuffled_once_from_the_dedup_to_the_assets(spark):
    for name in ("bars_unified", "liquid", "catalog_sources", "sma_backtest"):
        moved = shuffles_of_bars(registry.queries()[name](spark, SF))
        assert len(moved) == 1 and moved[0].startswith("pair_id"), (name, moved)


def test_one_shuffle_keeps_the_latest_row_of_bars_delivered_often(spark):
    again = [(pid, day, f"{pid}.{k}", T + dt.timedelta(hours=k)) for pid in (1, 2, 3) for day in days(4) for k in range(1, 9)]
    hist, e, a = raw_rows(spark, again), empty_raw(spark), assets(spark, [(1, "A", None), (2, "B", None)])
    dealt = unify_bars(hist, e, hist, e, a, strict=True, tasks=3)[0]
    assert sorted(map(str, dealt.collect())) == sorted(map(str, unify_bars(hist, e, hist, e, a, strict=True)[0].collect()))
    assert [(r.pair_id, float(r.last_close)) for r in dealt.orderBy("pair_id", "transaction_date").collect()] \
        == [(pid, float(f"{pid}.8")) for pid in (1, 2) for _ in range(4)]


def test_a_task_takes_few_stored_bytes():
    # bars take some thirty times that in memory, and a chain of windows holds several sorts at once
    assert 30 * TASK_BYTES <= 128 << 20


def test_raw_tables_are_stored_in_less(spark):
    from barlens.sources import testdata
    landed = testdata.landed_inputs(spark, SF)["historical_daily"]
    assert landed.inputFiles() and all(f.endswith(".zstd.parquet") for f in landed.inputFiles())


def test_a_load_is_not_shuffled_before_the_store_merges_it(spark):
    from barlens.plans import cycle
    from barlens.session import scratch_path
    rows = [(pid, day, f"{pid}.{k}", T + dt.timedelta(hours=k)) for pid in (1, 2) for day in days(20) for k in (1, 3, 2)]
    loaded = cycle.typed(raw_rows(spark, rows), "daily", 0)
    assert "Exchange" not in loaded._jdf.queryExecution().executedPlan().toString()
    store = cycle.bar_store(spark, scratch_path(spark, "test-repeats"))
    store.append(loaded, "history")
    for _ in range(2):           # merged when read, then when folded
        assert sorted((r.pair_id, float(r.last_close)) for r in store.latest().collect()) \
            == sorted((pid, float(f"{pid}.3")) for pid in (1, 2) for _ in range(20))
        store.compact()


def test_feeds_are_landed_side_by_side(spark, monkeypatch):
    """The daily feeds wait for each other here: landed one after the other they would never end."""
    import threading

    from barlens.sources import testdata
    met, land = threading.Barrier(2, timeout=60), testdata.Landing._land

    def waits(self, name, df):
        if name in ("historical_daily", "current_daily"):
            met.wait()
        return land(self, name, df)

    monkeypatch.setattr(testdata.Landing, "_land", waits)
    feeds = testdata.Landing(spark, SF).bar_feeds()
    monkeypatch.undo()
    alone = testdata.Landing(spark, SF)
    assert list(feeds) == list(testdata.FEEDS)
    for name, df in feeds.items():
        assert df.exceptAll(alone[name]).isEmpty() and alone[name].exceptAll(df).isEmpty(), name


def test_an_error_beside_other_jobs_is_raised(spark):
    import pytest

    from barlens.session import at_once
    done = []
    with pytest.raises(ZeroDivisionError):
        at_once(lambda: 1 // 0, lambda: done.append(spark.range(3).count()))
    assert done == [3]
