"""Plan checks: no nested-loop or cartesian joins, map-side top-1 for the
bar dedup, and one shuffle serving all series windows."""

import re

import pytest

from barlens.plans import registry

SF = "/root/testdata/sf0.001"
BATCH_QUERIES = [q for q in registry.queries() if q not in
                 ("ema_stream", "volume_spike_stream", "stream_latest", "bar_landing", "bar_csv",
                  "landing_corrupt", "sink_chain", "table_roundtrip", "asset_json", "ema_incremental_reseed",
                  "sma_stream", "stream_redelivered", "publish_replay", "bar_csv_staged", "catalog_sources")]


def plan(spark, name):
    df = registry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dedup_has_partial_top1_before_shuffle(spark):
    p = plan(spark, "bars_unified")
    assert re.search(r"WindowGroupLimit .*Partial", p) or p.count("WindowGroupLimit") >= 2


def test_sma_chain_shuffles(spark):
    p = plan(spark, "sma_backtest")
    hash_exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    # bar dedup key, asset dedup key, series key - nothing after the series shuffle
    assert len(hash_exchanges) <= 3, hash_exchanges
    assert "SortMergeJoin" not in p            # liquidity is a window, not a join
    assert "Expand" not in p                   # signals exploded, not unpivoted


def test_delivery_reads_stored_tables_and_calls_python_twice(spark):
    p = plan(spark, "ema_delivery")
    assert p.count("Scan parquet") <= 12, p.count("Scan parquet")
    assert p.count("MapInArrow") == 2 and "FlatMap" not in p


def test_scan_prunes_columns(spark):
    # every price text gates a row (unparseable -> quarantine), but unused
    # payload columns never leave the raw-bar scan
    p = plan(spark, "volume_spike")
    scans = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", p) if "row_date_timestamp" in s]
    assert scans
    for s in scans:
        for unused in ("direction_color", "row_date:", "row_date_raw", "last_close_raw", "change_percent:"):
            assert unused not in s, (unused, s)


def exchanges_of_bars(p):
    """Hash exchanges of a plan as text."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)


def final(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_hub_needs_no_exchange(spark):
    """Models that read the stored hub run on its buckets."""
    from barlens.operators.indicators import volume_spikes
    from barlens.plans import models
    hub = registry.stored_hub(spark, SF)
    for df in (models.sma_strategy(hub, 28.5), models.ema_strategy(hub, 28.5), volume_spikes(hub),
               models.sma_backtest(models.sma_crossover(models.sma_strategy(hub, 28.5)))):
        p = final(df)
        assert exchanges_of_bars(p) == [], p
        assert "Bucketed: true" in p or "SelectedBucketsCount" in p
    assert all(c.count("pair_id") for c in exchanges_of_bars(final(registry.q_hub_indicators(spark, SF)))) \
        or exchanges_of_bars(final(registry.q_hub_indicators(spark, SF))) == []
    compare = exchanges_of_bars(plan(spark, "strategy_compare"))
    # assets, the EMA's trades behind Python, the roll-ups: no exchange of the hub under either family
    assert len([c for c in compare if c.startswith(("pair_id", "pair_id#")) and "ticker" in c]) <= 1, compare


def test_cycle_opens_and_writes_its_weeks_only(spark):
    import datetime as dt

    from barlens.operators.universe import universe
    from barlens.plans import cycle
    from barlens.session import scratch_path
    from barlens.sources import testdata
    f = testdata.landed_inputs(spark, SF)
    store = cycle.bar_store(spark, scratch_path(spark, "test-cycle"))
    store.append(cycle.typed(f["historical_daily"], "daily", 0), "history")
    store.compact()
    before = store.snapshot()
    ids = universe(f["screen"], f["assets"])
    day = dt.date(2001, 6, 27)
    parts = cycle.weeks_of(day - dt.timedelta(days=15), day, "daily")
    assert all(re.search(r"daily-2001-06-(11|18|25)", name) for name in store.latest(parts).inputFiles())
    assert cycle.run_cycle(store, f["current_daily"], ids, day)
    after = store.snapshot()
    changed = {p for p in after.base if after.base[p] != before.base.get(p)}
    assert changed == {"daily-2001-06-11", "daily-2001-06-18", "daily-2001-06-25"}
    rows = store.latest().filter("_rank = 1")
    assert {r[0] for r in rows.select("transaction_date").distinct().collect()} <= {dt.date(2001, 6, 12) + dt.timedelta(days=k) for k in range(16)}
    assert rows.count() > 0 and not cycle.run_cycle(store, f["current_daily"], ids, "2001-06-27")
    assert store.snapshot().version == after.version
    with pytest.raises(ValueError):
        cycle.run_cycle(store, f["current_daily"], ids, "2001-06-31")


def test_pending_and_incremental_plans_run_no_job(spark):
    from barlens.operators.universe import pending
    from barlens.plans import models
    from barlens.sources import testdata
    f = testdata.landed_inputs(spark, SF)
    hub = registry.stored_hub(spark, SF)
    target = testdata.landed_inputs(spark, SF)["historical_daily"].selectExpr("CAST(row_date_timestamp AS DATE) AS transaction_date")
    group = "no-job-while-planning"
    spark.sparkContext.setJobGroup(group, group)
    try:
        frames = [pending(f["assets"].select("pair_id"), f["historical_daily"]),
                  registry.q_pending(spark, SF), registry.q_pending_null(spark, SF),
                  models.ema_incremental(hub, models.high_water(target), 28.5), registry.q_ema_incremental_resume(spark, SF)]
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
        assert all(df.columns for df in frames)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
