"""Registered queries (driver contract) and their DuckDB oracles.

Every query reads the driver's generated tables under ``sf_dir`` in full and
derives the engine's inputs from them (``barlens.sources.testdata``).
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable
from functools import partial, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.functions import cap_bucket, crossover
from barlens.operators.bars import (PRICE_FIELDS, bars_between, dedup_bars, frequency_counts, good_rows,
                                    tag_raw, type_bars, typed_feeds)
from barlens.operators.ema import apply_delivery, ema_resume, ema_state, with_ema
from barlens.operators.indicators import (EMA_PERIODS, SMA_PERIODS, daily_liquid_bars,
                                          liquid, volume_spikes, with_prev, with_seq)
from barlens.operators.signals import EMA_PAIRS, EMA_TRADED, SMA_PAIRS, SMA_TRADED
from barlens.operators.universe import pending, universe
from barlens.plans import cycle, models
from barlens.plans import oracle as O
from barlens.plans.hub import store_hub
from barlens.session import FREE_SHUFFLES, STORED, at_once, held, scratch_path, tasks_for
from barlens.schemas import RAW_BAR_PAYLOAD_FIELDS
from barlens.sinks import (STAGED, STAGED_FOLDERS, append_bars, append_newer, append_rows, as_view, create_table, delete_all, materialize,
                           publish, reload_partitions, replace_table, write_csv, write_sorted)
from barlens.sources import testdata
from barlens.streaming.bars import latest_view, live_bars, run_available_now, stream_bars, upsert_latest, without_repeats
from barlens.streaming.indicators import STATE_CONF, stream_indicators, with_rebuilt
from barlens.streaming.moving import sma_columns, stream_sma, with_rebuilt_sma
from barlens.sources.readers import (SOURCES, corrupt_bars, corrupt_csv, extract_html_table, load_sources, read_assets,
                                     read_bar_csv, read_bar_landing, valid_date, window_before)
from barlens.versioned import VersionedTable

# Fixed parameters of the registered queries.
# The generated bars count volume in lineitem quantity units (a few dozen a
# day), not shares, so the reference's 500000-share liquidity floor is
# restated in those units: 28.5 keeps about half of the instruments.
MIN_AVG_VOLUME = 28.5
RANGE = (dt.date(1998, 1, 1), dt.date(1999, 12, 31))
RESUME_CUT = dt.date(2000, 12, 31)
#: Days on which the delta cycle runs, and its window.
CYCLES = (dt.date(2001, 7, 3), dt.date(2001, 7, 17))
WINDOW_AS_OF, WINDOW_DAYS = "2001-06-20", 15
#: Files that a registered stream takes in one micro-batch.
STREAM_FILES = 64
#: Rows of a file in a delivery that is shuffled as it comes: the files of a micro-batch bound it only if they are bounded.
FILE_ROWS = 250_000


class Inputs:
    """Inputs for one scale directory: the landed raw tables (written once per
    application from the generated tables) and the plans built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.feeds = testdata.landed_inputs(spark, sf_dir)

    def tasks(self) -> int:
        """Partitions for steps over all bars, by the size of the landed feeds."""
        return tasks_for(*self.feeds.bar_feeds().values())

    def stock(self, current: bool = True, series: bool = False) -> DataFrame:
        """``stock_data``; for ``series``, dealt once by instrument, in partitions of one size."""
        feeds = {**self.feeds.bar_feeds(), "assets": self.feeds["assets"]}
        tasks = self.tasks() if series else None
        if not current:   # the table as it stood before the current feeds landed
            feeds["current_daily"] = feeds["current_daily"].filter(F.lit(False))
            feeds["current_weekly"] = feeds["current_weekly"].filter(F.lit(False))
        return models.stock_data(feeds, tasks)


def _inputs(spark, sf_dir) -> Inputs:
    return Inputs(spark, sf_dir)


def _frugal(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """For a query that writes several tables or many folders: the shuffle files of each table go as it is
    written, and its folders are listed in a few tasks for each core, not in one for each folder."""
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        listing = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}
        with held(spark, FREE_SHUFFLES | listing):
            return query(spark, sf_dir)
    return run


# The hub table of each (application, session, scale directory).
_HUBS: dict[tuple[str, int, str], str] = {}


def stored_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stock_data`` as a stored, bucketed table, written once per application: what the
    reference's models read (SNK-6)."""
    key = (spark.sparkContext.applicationId, id(spark), os.path.abspath(sf_dir))
    if key not in _HUBS:
        name = f"barlens_hub_{uuid.uuid4().hex[:12]}"
        inp = _inputs(spark, sf_dir)
        # as many buckets as the bars need, and dealt by them from the dedup on
        store_hub(inp.stock(series=True), name, scratch_path(spark, "hub"), buckets=inp.tasks())
        _HUBS[key] = name
    return spark.table(_HUBS[key])


# --- Spark side -------------------------------------------------------------

def q_bars_unified(spark, sf_dir):
    return _inputs(spark, sf_dir).stock(series=True)


def q_bars_latest(spark, sf_dir):
    f = _inputs(spark, sf_dir).feeds.bar_feeds()
    good, _ = typed_feeds(f["historical_daily"], f["historical_weekly"],
                          f["current_daily"], f["current_weekly"])
    return dedup_bars(good)


def q_bars_weekly_daily_counts(spark, sf_dir):
    return frequency_counts(_inputs(spark, sf_dir).stock())


def q_cap_bucket(spark, sf_dir):
    a = _inputs(spark, sf_dir).feeds["assets"]
    return a.select("pair_id", "market_cap", cap_bucket("market_cap").alias("market_cap_category"))


def q_bars_range(spark, sf_dir):
    return bars_between(_inputs(spark, sf_dir).stock(), *RANGE)


def q_universe(spark, sf_dir):
    f = _inputs(spark, sf_dir).feeds
    return universe(f["screen"], f["assets"])


def q_pending(spark, sf_dir):
    """MDL-2: compliant instruments without a row in the whole historical daily table."""
    f = _inputs(spark, sf_dir).feeds
    return pending(universe(f["screen"], f["assets"]), testdata.partly_loaded(f["historical_daily"]))


def q_pending_null(spark, sf_dir):
    """JN-4: the same while the table holds one row without instrument: SQL NOT IN is
    then unknown for every instrument."""
    f = _inputs(spark, sf_dir).feeds
    loaded = testdata.partly_loaded(f["historical_daily"]).select("pair_id")
    return pending(universe(f["screen"], f["assets"]),
                   loaded.unionByName(spark.createDataFrame([(None,)], "pair_id bigint")))


def q_pending_assets(spark, sf_dir):
    """MDL-2 over all assets, as a sequential load asks it; in order (AGG-5)."""
    f = _inputs(spark, sf_dir).feeds
    return pending(f["assets"].select("pair_id").distinct(), testdata.partly_loaded(f["historical_daily"]),
                   null_aware=False).orderBy("pair_id")


def q_bars_quarantine(spark, sf_dir):
    """MDL-3's rows left out: the feeds with spoilt bars among them; the good rows are the
    bars as they were, the others come back with the fields that spoilt them."""
    f = testdata.spoilt_feeds(_inputs(spark, sf_dir).feeds)
    good, bad = typed_feeds(f["historical_daily"], f["historical_weekly"], f["current_daily"], f["current_weekly"])
    kept = good.groupBy("pair_id", "frequency").agg(F.count(F.lit(1)).alias("n")).withColumn("reason", F.lit(None).cast("string"))
    left = bad.groupBy("pair_id", "frequency", "reason").agg(F.count(F.lit(1)).alias("n"))
    return kept.unionByName(left)


def q_liquid(spark, sf_dir):
    return liquid(_inputs(spark, sf_dir).stock(series=True), MIN_AVG_VOLUME)


def _sma(spark, sf_dir):
    return models.sma_strategy(_inputs(spark, sf_dir).stock(series=True), MIN_AVG_VOLUME)


def q_sma_strategy(spark, sf_dir):
    return _sma(spark, sf_dir)


def q_sma_crossover(spark, sf_dir):
    return models.sma_crossover(_sma(spark, sf_dir))


def q_sma_backtest(spark, sf_dir):
    return models.sma_backtest(models.sma_crossover(_sma(spark, sf_dir)))


def q_sma_backtest_per_strategy(spark, sf_dir):
    return models.sma_backtest(models.sma_crossover(_sma(spark, sf_dir)), collapse=False)


def _ema(spark, sf_dir):
    return models.ema_strategy(_inputs(spark, sf_dir).stock(series=True), MIN_AVG_VOLUME)


def q_ema_strategy(spark, sf_dir):
    return _ema(spark, sf_dir)


def q_ema_crossover(spark, sf_dir):
    return models.ema_crossover(_ema(spark, sf_dir))


def q_ema_crossover_loose(spark, sf_dir):
    ema = _ema(spark, sf_dir)
    return ema.withColumns({
        f"ema_signal_{a}_{b}": crossover(f"ema_{a}", f"ema_{b}", f"prev_ema_{a}",
                                         f"prev_ema_{b}", strict=False)
        for a, b in EMA_PAIRS})


def q_ema_backtest(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return models.ema_trades(inp.stock(series=True), inp.feeds["assets"], MIN_AVG_VOLUME)


def q_volume_spike(spark, sf_dir):
    return volume_spikes(_inputs(spark, sf_dir).stock(series=True))


def q_strategy_compare(spark, sf_dir):
    # both strategy families read the stored hub
    stock = stored_hub(spark, sf_dir)
    sma = models.sma_backtest(models.sma_crossover(models.sma_strategy(stock, MIN_AVG_VOLUME)))
    ema = models.ema_trades(stock, _inputs(spark, sf_dir).feeds["assets"], MIN_AVG_VOLUME)
    return models.strategy_compare(sma, ema)


def q_hub_indicators(spark, sf_dir):
    """SRC-5 / SNK-6: SMA, EMA and volume spikes of the stored hub, on its buckets as they lie."""
    hub = stored_hub(spark, sf_dir)
    keys = ["pair_id", "ticker", "transaction_date"]
    sma = models.sma_strategy(hub, MIN_AVG_VOLUME).select(*keys, "sma_5", "sma_150", "prev_sma_150")
    ema = models.ema_strategy(hub, MIN_AVG_VOLUME, columns=models.TRADE_BASE).select(*keys, "ema_9", "ema_50", "prev_ema_50")
    long = [df.unpivot(keys, [c for c in df.columns if c not in keys], "indicator", "value") for df in (sma, ema)]
    spikes = volume_spikes(hub).select(*keys, F.lit("avg_volume_30").alias("indicator"), F.col("avg_volume_30").alias("value"))
    return reduce(DataFrame.unionByName, [*long, spikes])


def q_catalog_sources(spark, sf_dir):
    """SRC-5: the five declared sources as catalog tables, read through the checked registry and unified."""
    inp = _inputs(spark, sf_dir)
    f = inp.feeds
    path, prefix = scratch_path(spark, "sources"), f"barlens_{uuid.uuid4().hex[:12]}_"
    feed_of = {n: "assets" if n == "assets_info" else n.replace("_stock_data", "") for n in SOURCES}
    for name, feed in feed_of.items():
        f[feed].write.options(**STORED).option("path", f"{path}/{name}").saveAsTable(prefix + name)
    tables = load_sources(spark, prefix=prefix)
    return models.stock_data({feed: tables[name] for name, feed in feed_of.items()}, inp.tasks())


def q_delta_cycle(spark, sf_dir):
    """E2: two scheduled cycles over stored bars, then the trades made from them. Each cycle
    loads a window of 15 days for the compliant instruments, corrections included."""
    f = _inputs(spark, sf_dir).feeds
    store = cycle.bar_store(spark, scratch_path(spark, "cycle-bars"))
    store.append(cycle.typed(f["historical_daily"], "daily", 0).unionByName(cycle.typed(f["historical_weekly"], "weekly", 0)),
                 "history")
    store.compact()
    for as_of in CYCLES:
        cycle.run_cycle(store, f["current_daily"], universe(f["screen"], f["assets"]), as_of)
    stock = cycle.stock_data(store, f["assets"])
    return models.sma_backtest(models.sma_crossover(models.sma_strategy(stock, MIN_AVG_VOLUME)))


def q_sma_backtest_sorted(spark, sf_dir):
    """SRT-1: the trades in their final order, with the position of each."""
    return write_sorted(q_sma_backtest(spark, sf_dir), [F.col("pair_id").asc(), F.col("buy_date").desc()])


def q_volume_spike_sorted(spark, sf_dir):
    """SRT-2: the spikes, latest first, with the position of each."""
    return write_sorted(q_volume_spike(spark, sf_dir), [F.col("transaction_date").desc(), F.col("pair_id").asc()])


def q_pending_assets_sorted(spark, sf_dir):
    """AGG-5: the instruments that are left to load as a sorted list."""
    return write_sorted(q_pending_assets(spark, sf_dir), [F.col("pair_id").asc()])


def q_bar_positions(spark, sf_dir):
    """WIN-2: each daily bar's position in its series, and the close before it."""
    bars = daily_liquid_bars(_inputs(spark, sf_dir).stock(series=True), MIN_AVG_VOLUME).select(
        "pair_id", "ticker", "transaction_date", "last_close")
    return with_prev(with_seq(bars), ["last_close"])


def q_bars_window(spark, sf_dir):
    """SC-14 / SC-15: per instrument, the raw current bars whose date, given as text, parses; those
    that fall into the window before a day; and those that don't parse."""
    raw = testdata.dated_as_text(_inputs(spark, sf_dir).feeds["current_daily"])
    lo, hi = window_before(dt.date.fromisoformat(WINDOW_AS_OF), WINDOW_DAYS)
    day = valid_date("date_text")
    return raw.groupBy("pair_id").agg(F.count(day).alias("n_valid"), F.count_if(day.between(F.lit(lo), F.lit(hi))).alias("n_window"),
                                      F.count_if(day.isNull()).alias("n_invalid"))


def q_publish_replay(spark, sf_dir):
    """SNK-2 / SNK-3: loads that are replayed and one that fails its check leave the table as it
    should be: history replaced, current bars appended, each once."""
    f = _inputs(spark, sf_dir).feeds
    path = scratch_path(spark, "published")
    cols = ["pair_id", "row_date_timestamp", "last_close_raw"]
    hist, cur = f["historical_daily"].select(*cols), f["current_daily"].select(*cols)

    def whole(rows: DataFrame) -> None:
        if not rows.filter("last_close_raw IS NULL").isEmpty():
            raise ValueError("a bar without close")

    def load(df, load_id, mode, at):
        return publish(spark, df, path, load_id, mode, loaded_at=at, validate=whole)

    load(cur, "first", "append", testdata.HISTORICAL_LOADED_AT)
    load(hist, "history", "replace", testdata.HISTORICAL_LOADED_AT)
    load(cur, "current", "append", testdata.CURRENT_LOADED_AT)
    for df, load_id, mode in ((hist, "history", "replace"), (cur, "current", "append"), (cur, "first", "append")):
        load(df, load_id, mode, testdata.CURRENT_LOADED_AT)             # replayed: nothing happens
    try:
        load(cur.withColumn("last_close_raw", F.lit(None).cast("string")), "broken", "replace", testdata.CURRENT_LOADED_AT)
    except ValueError:
        pass                                                            # kept out by its check
    return VersionedTable(spark, path).read()


def q_ema_incremental_reseed(spark, sf_dir):
    """Two runs of the reference's incremental model: the first over the table
    before the current feeds landed, the second over the refreshed table,
    limited to bars after the first run's global high-water mark."""
    inp = _inputs(spark, sf_dir)
    # the first run's result is a table; its mark is read from there, inside the second run's plan
    run1 = materialize(models.ema_incremental(inp.stock(current=False, series=True), None, MIN_AVG_VOLUME), "ema-run1")
    run2 = models.ema_incremental(stored_hub(spark, sf_dir), models.high_water(run1), MIN_AVG_VOLUME)
    return run1.unionByName(run2)


def q_ema_incremental_resume(spark, sf_dir):
    """Corrected incremental form: state after RESUME_CUT carried into the
    next batch; must equal the full recomputation after the cut."""
    # an incremental job reads a stored bar table
    bars = daily_liquid_bars(stored_hub(spark, sf_dir), MIN_AVG_VOLUME).select(
        "pair_id", "ticker", "stock_name", "transaction_date", "last_close")
    before = bars.filter(F.col("transaction_date") <= F.lit(RESUME_CUT))
    after = bars.filter(F.col("transaction_date") > F.lit(RESUME_CUT))
    state = ema_state(with_ema(before.drop("stock_name"), EMA_PERIODS, prev=False))
    # the cut divides the days, so no row after it can be late
    out = ema_resume(after, state)
    return out.withColumn(
        "crossover_signal",
        crossover("ema_9", "ema_21", "prev_ema_9", "prev_ema_21", strict=False),
    ).select(*models.INCREMENTAL_COLUMNS)


def q_asset_json(spark, sf_dir):
    """SRC-1: asset documents (one JSON page per line) -> assets_info."""
    t = partial(testdata.table, spark, sf_dir)
    path = scratch_path(spark, "asset-documents")
    testdata.asset_documents(t("supplier"), t("nation"), t("region")).write.text(path)
    return read_assets(spark, path, as_of=testdata.DOCUMENTS_LOADED_AT)


def q_html_table(spark, sf_dir):
    """SRC-2: screen rows extracted from HTML pages - the generated screen
    pages and the given ``pages`` table (whose pages hold no tables)."""
    t = partial(testdata.table, spark, sf_dir)
    pages = testdata.screen_pages(t("part")).unionByName(t("pages").select("page_id", "html"))
    return extract_html_table(pages, "html", as_of=testdata.DOCUMENTS_LOADED_AT)


def _typed_raw(raw: DataFrame, frequency: str) -> DataFrame:
    return good_rows(type_bars(tag_raw(raw, frequency, 1))).select(
        "pair_id", "transaction_date", "last_open", "last_close", "last_min", "last_max",
        "volume", "change_percent", "record_created_on")


@_frugal
def q_bar_landing(spark, sf_dir):
    """SRC-3: all four feeds landed as API documents, one per instrument and year
    (folders ``pair_id=<id>``), read back and typed."""
    f = _inputs(spark, sf_dir).feeds
    path = scratch_path(spark, "bar-landing")
    out = []
    for name, loaded_at in testdata.FEEDS.items():
        testdata.bar_documents(f[name], tasks_for(f[name])).write.partitionBy("pair_id").options(**STAGED_FOLDERS).text(f"{path}/{name}")
        raw = read_bar_landing(spark, f"{path}/{name}", loaded_at=loaded_at)
        out.append(_typed_raw(raw, name.split("_")[1]))
    return reduce(DataFrame.unionByName, out)


@_frugal
def q_landing_corrupt(spark, sf_dir):
    """SRC-1/3/4: documents and lines of all four feeds cut off in the middle, which the readers leave
    out, come back from the readers of corrupt records; with the rows that were read."""
    f = _inputs(spark, sf_dir).feeds
    path = scratch_path(spark, "corrupt-landing")
    parts: dict[str, list[DataFrame]] = {"read": [], "corrupt document": [], "corrupt line": []}
    for name, loaded_at in testdata.FEEDS.items():
        docs, lines = f"{path}/{name}/json", f"{path}/{name}/csv"
        # a document that is cut off comes beside the whole one, from the same task
        both = F.expr("CASE WHEN pair_id % 5 = 0 THEN array(value, substring(value, 1, length(value) - 20)) ELSE array(value) END")
        (testdata.bar_documents(f[name], tasks_for(f[name])).select("pair_id", F.explode(both).alias("value"))
         .write.partitionBy("pair_id").options(**STAGED_FOLDERS).text(docs))
        write_csv(f[name], lines, **STAGED)
        short = f[name].filter("pair_id % 7 = 0").select("pair_id", F.lit("cut").alias("rest"))
        short.write.mode("append").options(**STAGED).option("header", True).csv(lines)
        parts["read"].append(read_bar_landing(spark, docs, loaded_at=loaded_at).select("pair_id"))
        parts["corrupt document"].append(corrupt_bars(spark, docs).select("pair_id"))
        parts["corrupt line"].append(corrupt_csv(spark, lines).select("pair_id"))
    counted = [reduce(DataFrame.unionByName, dfs).groupBy("pair_id").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
               for kind, dfs in parts.items()]
    return reduce(DataFrame.unionByName, counted)


@_frugal
def q_bar_csv(spark, sf_dir):
    """SRC-4 + SNK-10: all four feeds staged as CSV and read back by position."""
    f = _inputs(spark, sf_dir).feeds.bar_feeds()
    path = scratch_path(spark, "bar-csv")
    at_once(*[partial(write_csv, f[name], f"{path}/{name}", **STAGED) for name in f])
    return reduce(DataFrame.unionByName, [_typed_raw(read_bar_csv(spark, f"{path}/{name}"), name.split("_")[1]) for name in f])


@_frugal
def q_bar_csv_staged(spark, sf_dir):
    """SRC-4: the daily feeds staged as the loader does, 16 columns by position, one folder per
    instrument, whose name and load time are stamped on the rows."""
    f = _inputs(spark, sf_dir).feeds
    path = scratch_path(spark, "bar-csv-staged")
    feeds = {name: f[name] for name in ("historical_daily", "current_daily")}

    def stage(name: str) -> None:
        (feeds[name].select(*RAW_BAR_PAYLOAD_FIELDS, "pair_id").repartition(tasks_for(feeds[name]), "pair_id").write.partitionBy("pair_id")
         .options(**STAGED_FOLDERS).option("header", True).csv(f"{path}/{name}"))

    at_once(*[partial(stage, name) for name in feeds])      # the folders of one are moved into place beside the other's tasks
    return reduce(DataFrame.unionByName, [
        _typed_raw(read_bar_csv(spark, f"{path}/{name}", loaded_at=testdata.FEEDS[name], by_folder=True), "daily") for name in feeds])


def q_sink_chain(spark, sf_dir):
    """SNK-2, 4, 5, 7, 8, 9 on a catalog table: create it, append the historical daily
    feed, delete all, append it again, append what is newer, and read it as a view."""
    f = _inputs(spark, sf_dir).feeds
    name = f"barlens_chain_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "sink-chain")
    cols = ["pair_id", "row_date_timestamp", "last_close_raw", "record_created_on"]
    hist, cur = f["historical_daily"].select(*cols), f["current_daily"].select(*cols)
    spark.sql(f"CREATE TABLE {name} (pair_id BIGINT, row_date_timestamp TIMESTAMP_NTZ, last_close_raw STRING, "
              f"record_created_on TIMESTAMP_NTZ) USING parquet LOCATION '{path}'")
    create_table(spark, name, hist.schema)          # already there: nothing happens
    append_rows(hist, name)
    delete_all(spark, name)
    append_bars(hist.drop("record_created_on"), name, loaded_at=testdata.HISTORICAL_LOADED_AT)
    append_newer(spark, cur, name, date_col="row_date_timestamp")
    as_view(spark.table(name), f"{name}_view")
    return spark.table(f"{name}_view")


def q_table_roundtrip(spark, sf_dir):
    """SNK-1/3/6: the unified table as it stood before the current feeds,
    written partitioned by frequency; then the weekly partition reloaded
    from the refreshed data (dynamic partition overwrite); read back."""
    inp = _inputs(spark, sf_dir)
    path = scratch_path(spark, "stock-data")
    replace_table(inp.stock(current=False), path, ["frequency"])
    reload_partitions(inp.stock().filter(F.col("frequency") == "weekly"), path, ["frequency"])
    return spark.read.parquet(path)


def _event_stream(spark, sf_dir, name: str, transform: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Land ``events`` in two batches (split at the median event id, some events late, some
    values NULL) and run ``transform`` as a stream once per landed batch (``availableNow``, one
    checkpoint). (what the stream has written, what has landed)."""
    ev = testdata.live_events(testdata.table(spark, sf_dir, "events"))
    cut = ev.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    base = scratch_path(spark, name)
    landing, out, ckpt = f"{base}/landing", f"{base}/out", f"{base}/checkpoint"
    # of some instruments every seventh early event comes with the second delivery, late
    held_back = (F.col("user_id") % 5 == 0) & (F.col("event_id") % 7 == 3)
    first = F.coalesce((F.col("event_id") <= cut) & ~held_back, F.lit(False))
    for batch in (ev.filter(first), ev.filter(~first)):
        batch.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", STREAM_FILES).parquet(landing)
        run_available_now(transform(stream).writeStream.format("parquet")
                          .option("path", out).option("checkpointLocation", ckpt)
                          .outputMode("append"),
                          spark=spark, state_partitions=spark.sparkContext.defaultParallelism, conf=STATE_CONF)
    return spark.read.parquet(out), spark.read.parquet(landing)


def _indicator_stream(spark, sf_dir, name: str) -> DataFrame:
    return with_rebuilt(*_event_stream(spark, sf_dir, name, stream_indicators))


def q_sma_stream(spark, sf_dir):
    """WIN-8, WIN-11, MDL-5 on a stream: moving averages, lags and signals carried across
    micro-batches; instruments with late rows rebuilt."""
    out = with_rebuilt_sma(*_event_stream(spark, sf_dir, "sma-stream", stream_sma))
    return out.select("user_id", "ts", "event_id", "value", *sma_columns())


def q_ema_stream(spark, sf_dir):
    """ST-1/3/4: EMAs, lags and the 9/21 signal carried across micro-batches."""
    out = _indicator_stream(spark, sf_dir, "ema-stream")
    return out.select(
        "user_id", "ts", "event_id", "value",
        *[f"ema_{n}" for n in EMA_PERIODS], *[f"prev_ema_{n}" for n in EMA_PERIODS],
        "ema_signal_9_21")


def q_volume_spike_stream(spark, sf_dir):
    """ST-5: trailing 30-row mean kept in list state; spike rows only."""
    out = _indicator_stream(spark, sf_dir, "spike-stream")
    return out.filter(F.col("volume_status") == "VOLUME SPIKE").select(
        "user_id", "ts", "event_id", "value", "avg_value_30", "volume_status")


@_frugal
def q_stream_latest(spark, sf_dir):
    """ST-1/2/6: the raw feeds landed in two deliveries (historical, then
    current) and upserted batch by batch; the merged view is the latest row
    per bar key."""
    f = _inputs(spark, sf_dir).feeds.bar_feeds()
    base = scratch_path(spark, "bars-stream")
    landing, target, ckpt = f"{base}/landing", f"{base}/table", f"{base}/checkpoint"
    tag = lambda name, freq: f[name].withColumn("frequency", F.lit(freq))
    deliveries = (tag("historical_daily", "daily").unionByName(tag("historical_weekly", "weekly")),
                  tag("current_daily", "daily").unionByName(tag("current_weekly", "weekly")))
    for d in deliveries:
        d.write.options(**STORED).mode("append").parquet(landing)
        run_available_now(stream_bars(spark, landing, STREAM_FILES).writeStream
                          .foreachBatch(upsert_latest(target, compact_every=2))
                          .option("checkpointLocation", ckpt))
        live_bars(spark, target).vacuum()           # no load is running; folded folders go
    return latest_view(spark, target)


@_frugal
def q_stream_redelivered(spark, sf_dir):
    """ST-6: deliveries that overlap. The daily feeds come one after the other, then both come again
    for the last 15 days that they share: identical bars are dropped, the corrected ones of June stay."""
    f = _inputs(spark, sf_dir).feeds
    base = scratch_path(spark, "redelivered")
    landing, out, ckpt = f"{base}/landing", f"{base}/out", f"{base}/checkpoint"
    daily = {n: f[n].withColumn("frequency", F.lit("daily")) for n in ("historical_daily", "current_daily")}
    day = F.col("row_date_timestamp").cast("date")
    again = [d.filter(day >= F.date_sub(F.lit(testdata.HISTORICAL_BEFORE), 15))
             .withColumn("record_created_on", F.col("record_created_on") + F.expr("INTERVAL 1 DAY")) for d in daily.values()]
    for d in (*daily.values(), again[0].unionByName(again[1])):
        d.write.options(**STORED, maxRecordsPerFile=FILE_ROWS).mode("append").parquet(landing)
        stream = without_repeats(stream_bars(spark, landing, STREAM_FILES))
        run_available_now(stream.writeStream.format("parquet").options(**STORED).option("path", out).option("checkpointLocation", ckpt)
                          .outputMode("append"), spark=spark, state_partitions=spark.sparkContext.defaultParallelism,
                          conf=STATE_CONF)
    typed = good_rows(type_bars(spark.read.parquet(out).withColumn("_source_rank", F.lit(0))))
    return typed.select("pair_id", "transaction_date", *PRICE_FIELDS, "volume", "record_created_on")


def q_ema_delivery(spark, sf_dir):
    """Corrected incremental EMA (EMA-2, ST-6): the EMA table as it stood
    before the current feeds, then the current feeds' days delivered -
    corrected June bars make their series rebuild, the rest resume from
    state; series that fell below the liquidity floor leave. Must equal
    recomputing the whole table."""
    inp = _inputs(spark, sf_dir)
    narrow = ["pair_id", "ticker", "stock_name", "transaction_date", "last_close"]
    before = daily_liquid_bars(inp.stock(current=False, series=True), MIN_AVG_VOLUME).select(*narrow)
    # an incremental job finds its inputs stored: the bars, the table so far, its state
    after = daily_liquid_bars(stored_hub(spark, sf_dir), MIN_AVG_VOLUME).select(*narrow)
    history = materialize(with_ema(before), "delivery-history")
    state = materialize(ema_state(history), "delivery-state")
    delivered = after.filter(F.col("transaction_date") >= F.lit(testdata.CURRENT_FROM))
    return apply_delivery(history, state, delivered, after)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bars_unified": q_bars_unified,
    "bars_latest": q_bars_latest,
    "bars_weekly_daily_counts": q_bars_weekly_daily_counts,
    "cap_bucket": q_cap_bucket,
    "bars_range": q_bars_range,
    "universe": q_universe,
    "pending": q_pending,
    "pending_null": q_pending_null,
    "pending_assets": q_pending_assets,
    "bars_quarantine": q_bars_quarantine,
    "liquid": q_liquid,
    "sma_strategy": q_sma_strategy,
    "sma_crossover": q_sma_crossover,
    "sma_backtest": q_sma_backtest,
    "sma_backtest_per_strategy": q_sma_backtest_per_strategy,
    "ema_strategy": q_ema_strategy,
    "ema_crossover": q_ema_crossover,
    "ema_crossover_loose": q_ema_crossover_loose,
    "ema_backtest": q_ema_backtest,
    "volume_spike": q_volume_spike,
    "strategy_compare": q_strategy_compare,
    "ema_incremental_reseed": q_ema_incremental_reseed,
    "ema_incremental_resume": q_ema_incremental_resume,
    "ema_delivery": q_ema_delivery,
    "asset_json": q_asset_json,
    "html_table": q_html_table,
    "bar_landing": q_bar_landing,
    "bar_csv": q_bar_csv,
    "landing_corrupt": q_landing_corrupt,
    "sink_chain": q_sink_chain,
    "table_roundtrip": q_table_roundtrip,
    "ema_stream": q_ema_stream,
    "volume_spike_stream": q_volume_spike_stream,
    "stream_latest": q_stream_latest,
    "sma_stream": q_sma_stream,
    "stream_redelivered": q_stream_redelivered,
    "hub_indicators": q_hub_indicators,
    "catalog_sources": q_catalog_sources,
    "delta_cycle": q_delta_cycle,
    "publish_replay": q_publish_replay,
    "sma_backtest_sorted": q_sma_backtest_sorted,
    "volume_spike_sorted": q_volume_spike_sorted,
    "pending_assets_sorted": q_pending_assets_sorted,
    "bar_csv_staged": q_bar_csv_staged,
    "bar_positions": q_bar_positions,
    "bars_window": q_bars_window,
}


# --- Oracle side --------------------------------------------------------------

ATTRS = ("pair_id, ticker, stock_name, primary_uid, primary_sector, secondary_sector, "
         "market_cap, market_cap_category")


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _signal_case(kind: str, a: int, b: int, strict: bool = True) -> str:
    lt, gt = ("<", ">") if strict else ("<=", ">=")
    f, s, pf, ps = f"{kind}_{a}", f"{kind}_{b}", f"prev_{kind}_{a}", f"prev_{kind}_{b}"
    return (f"CASE WHEN {f} > {s} AND {pf} {lt} {ps} THEN 'BUY' "
            f"WHEN {f} < {s} AND {pf} {gt} {ps} THEN 'SELL' END AS {kind}_signal_{a}_{b}")


def _sma_ctes() -> str:
    smas = ",\n    ".join(O.sma_expr("last_close", n, f"sma_{n}") for n in SMA_PERIODS)
    lags = ",\n    ".join(f"LAG(sma_{n}) OVER w AS prev_sma_{n}" for n in SMA_PERIODS)
    sigs = ",\n    ".join(_signal_case("sma", a, b) for a, b in SMA_PAIRS)
    return f"""
sma_base AS (
  SELECT {ATTRS}, transaction_id, quarter_start, transaction_date, volume,
    last_min, last_max, last_open, last_close,
    {smas}
  FROM liquid_daily),
sma_strategy AS (
  SELECT *, {lags}
  FROM sma_base WINDOW w AS (PARTITION BY pair_id, ticker ORDER BY transaction_date)),
sma_crossover AS (
  SELECT *, {sigs}
  FROM sma_strategy)"""


def _ema_ctes(src: str = "liquid_daily", name: str = "ema_strategy",
              cols: str | None = None) -> str:
    cols = cols or (f"{ATTRS}, transaction_id, transaction_date, volume, "
                    "last_min, last_max, last_open, last_close")
    steps = ", ".join(
        f"r.x * (2.0::DOUBLE / {n + 1}) + e.ema_{n} * (1 - 2.0::DOUBLE / {n + 1})"
        for n in EMA_PERIODS)
    lags = ", ".join(f"LAG(e.ema_{n}) OVER w AS prev_ema_{n}" for n in EMA_PERIODS)
    emas = ", ".join(f"e.ema_{n}" for n in EMA_PERIODS)
    r_cols = ", ".join(f"r.{c.strip()}" for c in cols.split(","))
    return f"""
{name}_ranked AS (
  SELECT {cols}, CAST(last_close AS DOUBLE) AS x,
         row_number() OVER (PARTITION BY pair_id, ticker ORDER BY transaction_date) AS seq
  FROM {src}),
{name}_rec(pair_id, ticker, seq, ema_9, ema_21, ema_50) AS (
  SELECT pair_id, ticker, seq, x, x, x FROM {name}_ranked WHERE seq = 1
  UNION ALL
  SELECT r.pair_id, r.ticker, r.seq, {steps}
  FROM {name}_rec e JOIN {name}_ranked r
    ON r.pair_id = e.pair_id AND r.ticker = e.ticker AND r.seq = e.seq + 1),
{name} AS (
  SELECT {r_cols}, {emas}, {lags}
  FROM {name}_ranked r JOIN {name}_rec e
    ON r.pair_id = e.pair_id AND r.ticker = e.ticker AND r.seq = e.seq
  WINDOW w AS (PARTITION BY r.pair_id, r.ticker ORDER BY r.transaction_date))"""


def _trades_ctes(name: str, src: str, strategies, collapse: bool, keep_rank: bool) -> str:
    """Each BUY meets the nearest later SELL of its strategy (as-of join); of a BUY day's
    strategies the one that sells first, then by name, is kept."""
    signals = ", ".join(strategies)
    attrs = ", ".join(f"b.{c.strip()}" for c in ATTRS.split(","))
    one = "first_of = 1" if collapse else "TRUE"
    rn = ", CAST(1 AS INTEGER) AS rn" if keep_rank else ""
    return f"""
{name}_marks AS (
  UNPIVOT (SELECT {ATTRS}, transaction_date, volume, last_close, {signals} FROM {src})
  ON {signals} INTO NAME strategy VALUE side),
{name}_met AS (
  SELECT {attrs}, b.transaction_date AS buy_date, s.transaction_date AS sell_date, b.volume,
         b.last_close AS buy_price, s.last_close AS sell_price, b.strategy,
         row_number() OVER (PARTITION BY b.pair_id, b.transaction_date
                            ORDER BY s.transaction_date, b.strategy) AS first_of
  FROM (FROM {name}_marks WHERE side = 'BUY') b
  ASOF JOIN (FROM {name}_marks WHERE side = 'SELL') s
    ON b.pair_id = s.pair_id AND b.strategy = s.strategy AND b.transaction_date < s.transaction_date),
{name} AS (
  SELECT {ATTRS}, buy_date, sell_date, volume, buy_price, sell_price, strftime(buy_date, '%Y') AS buy_year,
         strftime(sell_date, '%Y') AS sell_year, 'CLOSED' AS status, strategy{rn}, {O.pnl_sql()}
  FROM {name}_met WHERE {one})"""


def _with(*extra: str) -> str:
    return O.with_ctes(O.liquid_cte(MIN_AVG_VOLUME), *extra)


def _incremental_select(src: str, pred: str = "TRUE") -> str:
    sig = _signal_case("ema", 9, 21, strict=False).replace(" AS ema_signal_9_21", "")
    return (f"SELECT pair_id, ticker, stock_name, transaction_date, ema_9, ema_21, ema_50, "
            f"prev_ema_9, prev_ema_21, {sig} AS crossover_signal FROM {src} WHERE {pred}")


def _oracles() -> dict[str, str]:
    lo, hi = RANGE
    o: dict[str, str] = {}
    o["bars_unified"] = O.with_ctes() + "SELECT * FROM stock_data"
    o["bars_latest"] = O.with_ctes() + (
        "SELECT pair_id, transaction_date, last_open, last_close, last_min, last_max, volume, "
        "change_percent, frequency, loaded AS record_created_on FROM latest")
    o["bars_weekly_daily_counts"] = O.with_ctes() + (
        "SELECT frequency, COUNT(*) AS n_bars, COUNT(DISTINCT pair_id) AS n_instruments, "
        "MIN(transaction_date) AS first_date, MAX(transaction_date) AS last_date "
        "FROM stock_data GROUP BY frequency")
    o["cap_bucket"] = O.with_ctes() + (
        f"SELECT pair_id, market_cap, {O.CAP_CASE} AS market_cap_category FROM assets")
    o["bars_range"] = O.with_ctes() + (
        f"SELECT * FROM stock_data WHERE transaction_date BETWEEN {_d(lo)} AND {_d(hi)}")
    universe_sql = """
universe AS (
  SELECT DISTINCT pair_id FROM assets
  WHERE EXISTS (
    SELECT 1 FROM screen WHERE halal_ind = 'True' AND list_contains(
      list_transform(list_filter([uid, primary_uid], lambda i: contains(i, ':')),
                     lambda i: regexp_replace(i, '^[^:]*:', '')), upper(trim(nse_code)))))"""
    o["universe"] = O.with_ctes(universe_sql) + "SELECT pair_id FROM universe"
    loaded = f"SELECT pair_id FROM bars WHERE transaction_date < {O.HIST_BEFORE} AND pair_id % 9 <> 4"
    o["pending"] = O.with_ctes(universe_sql) + f"SELECT pair_id FROM universe WHERE pair_id NOT IN ({loaded})"
    o["pending_null"] = O.with_ctes(universe_sql) + (
        f"SELECT pair_id FROM universe WHERE pair_id NOT IN ({loaded} UNION ALL SELECT NULL)")
    o["pending_assets"] = O.with_ctes() + f"SELECT DISTINCT pair_id FROM assets EXCEPT ({loaded})"
    o["bars_quarantine"] = O.with_ctes() + """
SELECT pair_id, frequency, reason, COUNT(*) AS n FROM (
  SELECT pair_id, frequency, CASE
    WHEN pair_id % 6 = 1 AND day(transaction_date) = 3 THEN 'last_close'
    WHEN pair_id % 6 = 2 AND day(transaction_date) = 4 THEN 'last_open,volume_raw'
    WHEN pair_id % 6 = 3 AND day(transaction_date) = 5 THEN 'row_date_timestamp' END AS reason
  FROM typed)
GROUP BY ALL"""
    o["landing_corrupt"] = O.with_ctes("""
per_year AS (SELECT src, frequency, pair_id, year(transaction_date) AS y, COUNT(*) AS n FROM typed GROUP BY ALL)""") + """
SELECT pair_id, CAST(SUM(n) AS BIGINT) AS n, 'read' AS kind FROM per_year GROUP BY pair_id
UNION ALL SELECT pair_id, COUNT(*), 'corrupt document' FROM per_year WHERE pair_id % 5 = 0 GROUP BY pair_id
UNION ALL SELECT pair_id, CAST(SUM(n) AS BIGINT), 'corrupt line' FROM per_year WHERE pair_id % 7 = 0 GROUP BY pair_id"""
    o["sink_chain"] = O.with_ctes() + f"""
SELECT pair_id, CAST(transaction_date AS TIMESTAMP) AS row_date_timestamp, CAST(last_close AS VARCHAR) AS last_close_raw,
       loaded AS record_created_on
FROM feed_rows
WHERE frequency = 'daily' AND (src = 0 OR transaction_date > (
  SELECT MAX(transaction_date) FROM feed_rows WHERE src = 0 AND frequency = 'daily'))"""
    o["liquid"] = _with() + "SELECT pair_id, avg_volume FROM liquid"
    o["sma_strategy"] = _with(_sma_ctes()) + "SELECT * FROM sma_strategy"
    o["sma_crossover"] = _with(_sma_ctes()) + "SELECT * FROM sma_crossover"
    o["sma_backtest"] = _with(
        _sma_ctes(), _trades_ctes("trades", "sma_crossover", SMA_TRADED, True, True)) + "SELECT * FROM trades"
    o["sma_backtest_per_strategy"] = _with(
        _sma_ctes(), _trades_ctes("trades", "sma_crossover", SMA_TRADED, False, False)) + "SELECT * FROM trades"
    ema_sigs = ", ".join(_signal_case("ema", a, b) for a, b in EMA_PAIRS)
    ema_loose = ", ".join(_signal_case("ema", a, b, strict=False) for a, b in EMA_PAIRS)
    ema_cross = f"\nema_crossover AS (SELECT *, {ema_sigs} FROM ema_strategy)"
    o["ema_strategy"] = _with(_ema_ctes()) + "SELECT * FROM ema_strategy"
    o["ema_crossover"] = _with(_ema_ctes(), ema_cross) + "SELECT * FROM ema_crossover"
    o["ema_crossover_loose"] = _with(_ema_ctes()) + f"SELECT *, {ema_loose} FROM ema_strategy"
    o["ema_backtest"] = _with(_ema_ctes(), ema_cross,
                              _trades_ctes("trades", "ema_crossover", EMA_TRADED, True, False)) + "SELECT * FROM trades"
    o["volume_spike"] = O.with_ctes() + f"""
SELECT *, 'VOLUME SPIKE' AS volume_status FROM (
  SELECT pair_id, ticker, stock_name, transaction_date, volume,
         {O.sma_expr('volume', 30, 'avg_volume_30')}
  FROM stock_data WHERE frequency = 'daily')
WHERE volume > 1.5 * avg_volume_30"""
    roll = """
rollup AS (
  SELECT buy_year, market_cap_category, strategy, CAST(SUM(profit_or_loss) AS DECIMAL(31,2)) AS pl,
         COUNT(*) AS no_of_trades
  FROM (SELECT buy_year, market_cap_category, strategy, profit_or_loss FROM ema_trades
        UNION ALL
        SELECT buy_year, market_cap_category, strategy, profit_or_loss FROM sma_trades) u
  GROUP BY 1, 2, 3)"""
    o["strategy_compare"] = _with(
        _sma_ctes(), _ema_ctes(), ema_cross,
        _trades_ctes("sma_trades", "sma_crossover", SMA_TRADED, True, True),
        _trades_ctes("ema_trades", "ema_crossover", EMA_TRADED, True, False), roll) + """
SELECT *,
  CAST(row_number() OVER (PARTITION BY market_cap_category, buy_year
                          ORDER BY pl DESC NULLS LAST, strategy) AS INTEGER) AS rank_best_strategy_for_market,
  CAST(row_number() OVER (PARTITION BY strategy, buy_year
                          ORDER BY pl DESC NULLS LAST, market_cap_category) AS INTEGER) AS rank_best_market_for_strategy,
  CAST(row_number() OVER (PARTITION BY strategy
                          ORDER BY pl DESC NULLS LAST, buy_year, market_cap_category) AS INTEGER) AS rank_best_market_for_strategy_overall,
  CAST(row_number() OVER (PARTITION BY market_cap_category
                          ORDER BY pl DESC NULLS LAST, buy_year, strategy) AS INTEGER) AS rank_best_strategy_for_market_overall
FROM rollup"""
    narrow = "pair_id, ticker, stock_name, transaction_date, last_close"
    v1 = """
latest_v1 AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pair_id, frequency, transaction_date
                                 ORDER BY loaded DESC NULLS LAST, src DESC) AS rn
    FROM typed WHERE src = 0) WHERE rn = 1),
stock_v1 AS (
  SELECT l.pair_id, l.transaction_date, l.last_close, l.volume, l.frequency, a.ticker, a.stock_name
  FROM latest_v1 l JOIN assets a ON l.pair_id = a.pair_id),
liquid_v1 AS (
  SELECT pair_id FROM stock_v1 WHERE frequency = 'daily' GROUP BY pair_id
  HAVING CAST(SUM(volume) AS DOUBLE) / COUNT(volume) > {thr}),
daily_v1 AS (
  SELECT * FROM stock_v1 WHERE frequency = 'daily' AND pair_id IN (SELECT pair_id FROM liquid_v1)),
daily_v2 AS (
  SELECT * FROM liquid_daily
  WHERE transaction_date > (SELECT MAX(transaction_date) FROM daily_v1))""".replace(
        "{thr}", repr(MIN_AVG_VOLUME))
    o["ema_incremental_reseed"] = _with(
        v1, _ema_ctes("daily_v1", "run1", narrow), _ema_ctes("daily_v2", "run2", narrow)) + (
        _incremental_select("run1") + "\nUNION ALL\n" + _incremental_select("run2"))
    o["ema_delivery"] = _with(_ema_ctes("liquid_daily", "fullrun", narrow)) + (
        "SELECT pair_id, ticker, stock_name, transaction_date, last_close, ema_9, ema_21, ema_50, "
        "prev_ema_9, prev_ema_21, prev_ema_50 FROM fullrun")
    o["ema_incremental_resume"] = _with(_ema_ctes("liquid_daily", "fullrun", narrow)) + (
        _incremental_select("fullrun", f"transaction_date > {_d(RESUME_CUT)}"))
    o["asset_json"] = f"""
SELECT 'NSEI:' || upper(s_name) AS uid, s_suppkey AS pair_id, s_name AS ticker,
       s_name AS stock_name, 'NSEI:' || upper(s_name) AS primary_uid,
       '/equities/' || lower(s_name) AS path, n_name AS sector,
       CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 11 = 0 OR s_acctbal < 0 THEN NULL
            ELSE CAST(CAST(CAST(s_acctbal AS DECIMAL(12,2)) * 300000000 AS DECIMAL(24,2))
                      AS DECIMAL(24,4)) END AS market_cap,
       r_name AS primary_sector, n_name AS secondary_sector,
       TIMESTAMP '{testdata.DOCUMENTS_LOADED_AT.isoformat(sep=' ')}' AS record_created_on
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
    o["html_table"] = f"""
SELECT CASE WHEN p_size % 3 <> 0 THEN 'True' ELSE 'False' END AS halal_ind,
       p_name AS stock_name, CAST(p_partkey + 100000 AS VARCHAR) AS bse_code,
       upper(replace(p_name, ' ', '-')) AS nse_code, p_type || ' & ' || p_brand AS industry,
       TIMESTAMP '{testdata.DOCUMENTS_LOADED_AT.isoformat(sep=' ')}' AS record_created_on
FROM part"""
    typed_cols = ("SELECT pair_id, transaction_date, last_open, last_close, last_min, last_max, "
                  "volume, change_percent, loaded AS record_created_on FROM typed ")
    o["bar_landing"] = O.with_ctes() + typed_cols
    o["bar_csv"] = O.with_ctes() + typed_cols
    o["table_roundtrip"] = O.with_ctes(O.latest_cte("latest_v1", "src = 0"),
                                       O.stock_data_cte("stock_v1", "latest_v1")) + (
        "SELECT * FROM stock_v1 WHERE frequency = 'daily' "
        "UNION ALL SELECT * FROM stock_data WHERE frequency = 'weekly'")
    o["stream_latest"] = o["bars_latest"]
    steps = ", ".join(
        f"r.value * (2.0::DOUBLE / {n + 1}) + e.ema_{n} * (1 - 2.0::DOUBLE / {n + 1})"
        for n in EMA_PERIODS)
    lags = ", ".join(f"LAG(e.ema_{n}) OVER w AS prev_ema_{n}" for n in EMA_PERIODS)
    o["ema_stream"] = f"""
WITH RECURSIVE live AS (
  SELECT user_id, ts, event_id, CASE WHEN user_id % 4 <> 1 OR event_id % 11 <> 5 THEN value END AS value FROM events),
r AS (
  SELECT user_id, ts, event_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq
  FROM live),
rec(user_id, seq, ema_9, ema_21, ema_50) AS (
  SELECT user_id, seq, value, value, value FROM r WHERE seq = 1
  UNION ALL
  SELECT r.user_id, r.seq, {steps}
  FROM rec e JOIN r ON r.user_id = e.user_id AND r.seq = e.seq + 1),
ind AS (
  SELECT r.user_id, r.ts, r.event_id, r.value, e.ema_9, e.ema_21, e.ema_50, {lags}
  FROM r JOIN rec e ON r.user_id = e.user_id AND r.seq = e.seq
  WINDOW w AS (PARTITION BY r.user_id ORDER BY r.seq))
SELECT *, {_signal_case("ema", 9, 21, strict=False)} FROM ind"""
    o["volume_spike_stream"] = """
SELECT user_id, ts, event_id, value, avg_value_30, 'VOLUME SPIKE' AS volume_status FROM (
  SELECT user_id, ts, event_id, value,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / COUNT(value) OVER w AS avg_value_30
  FROM (SELECT user_id, ts, event_id, CASE WHEN user_id % 4 <> 1 OR event_id % 11 <> 5 THEN value END AS value FROM events)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
WHERE value > 1.5 * avg_value_30"""
    live = "(SELECT user_id, ts, event_id, CASE WHEN user_id % 4 <> 1 OR event_id % 11 <> 5 THEN value END AS value FROM events)"
    means = ", ".join(
        f"CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER ({over} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) "
        f"/ nullif(COUNT(value) OVER ({over} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 0) AS sma_{n}"
        for over in ["PARTITION BY user_id ORDER BY ts, event_id"] for n in SMA_PERIODS)
    lags = ", ".join(f"LAG(sma_{n}) OVER w AS prev_sma_{n}" for n in SMA_PERIODS)
    o["sma_stream"] = f"""
WITH m AS (SELECT *, {means} FROM {live}),
l AS (SELECT *, {lags} FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT *, {", ".join(_signal_case("sma", a, b) for a, b in SMA_PAIRS)} FROM l"""
    o["stream_redelivered"] = O.with_ctes() + (
        "SELECT pair_id, transaction_date, last_open, last_close, last_min, last_max, volume, loaded AS record_created_on "
        "FROM typed WHERE frequency = 'daily'")
    keys = "pair_id, ticker, transaction_date"
    parts = [("sma_strategy", ("sma_5", "sma_150", "prev_sma_150")), ("ema_strategy", ("ema_9", "ema_50", "prev_ema_50"))]
    o["hub_indicators"] = _with(_sma_ctes(), _ema_ctes()) + " UNION ALL ".join(
        f"SELECT {keys}, '{c}' AS indicator, {c} AS value FROM {src}" for src, cols in parts for c in cols) + f"""
UNION ALL SELECT {keys}, 'avg_volume_30', a FROM (
  SELECT *, {O.sma_expr('volume', 30, 'a')} FROM stock_data WHERE frequency = 'daily') WHERE volume > 1.5 * a"""
    days = " OR ".join(f"transaction_date BETWEEN {_d(x)} - {cycle.DELTA_DAYS} AND {_d(x)}" for x in CYCLES)
    o["delta_cycle"] = O.with_ctes(
        universe_sql,
        O.latest_cte("latest_c", f"src = 0 OR frequency = 'daily' AND ({days}) AND pair_id IN (SELECT pair_id FROM universe)"),
        O.stock_data_cte("stock_c", "latest_c"), O.liquid_cte(MIN_AVG_VOLUME).replace("FROM stock_data", "FROM stock_c"),
        _sma_ctes(), _trades_ctes("trades", "sma_crossover", SMA_TRADED, True, True)) + "SELECT * FROM trades"
    o["catalog_sources"] = o["bars_unified"]
    o["publish_replay"] = O.with_ctes() + """
SELECT pair_id, CAST(transaction_date AS TIMESTAMP) AS row_date_timestamp, CAST(last_close AS VARCHAR) AS last_close_raw,
       loaded AS record_created_on
FROM feed_rows WHERE frequency = 'daily'"""
    o["sma_backtest_sorted"] = _with(
        _sma_ctes(), _trades_ctes("trades", "sma_crossover", SMA_TRADED, True, True)) + (
        "SELECT *, row_number() OVER (ORDER BY pair_id, buy_date DESC) AS position FROM trades")
    o["volume_spike_sorted"] = "SELECT *, row_number() OVER (ORDER BY transaction_date DESC, pair_id) AS position FROM (" + (
        o["volume_spike"]) + ")"
    o["pending_assets_sorted"] = "SELECT pair_id, row_number() OVER (ORDER BY pair_id) AS position FROM (" + o["pending_assets"] + ")"
    o["bar_csv_staged"] = O.with_ctes() + typed_cols + "WHERE frequency = 'daily'"
    o["bar_positions"] = _with() + """
SELECT pair_id, ticker, transaction_date, last_close, CAST(row_number() OVER w AS INTEGER) AS seq_num,
       lag(last_close) OVER w AS prev_last_close
FROM liquid_daily WINDOW w AS (PARTITION BY pair_id, ticker ORDER BY transaction_date)"""
    o["bars_window"] = O.with_ctes() + f"""
SELECT pair_id, COUNT(*) FILTER (NOT (pair_id % 4 = 1 AND day(transaction_date) = 9)) AS n_valid,
       COUNT(*) FILTER (NOT (pair_id % 4 = 1 AND day(transaction_date) = 9)
                        AND transaction_date BETWEEN DATE '{WINDOW_AS_OF}' - {WINDOW_DAYS} AND DATE '{WINDOW_AS_OF}') AS n_window,
       COUNT(*) FILTER (pair_id % 4 = 1 AND day(transaction_date) = 9) AS n_invalid
FROM feed_rows WHERE src = 1 AND frequency = 'daily' GROUP BY pair_id"""
    return o


ORACLES = _oracles()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
