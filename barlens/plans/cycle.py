"""E2: the scheduled delta cycle over stored bars (SC-14, SC-15, SRC-7, SNK-3, MDL-1, MDL-3).

One cycle takes the bars of a window that ends today, for the instruments of the universe,
and puts them in the place of what the bar table holds of them, in one step; the
models are then made from the table. The table is laid out by frequency and week
(``MergeTable`` parts), so a cycle opens and rewrites the weeks of its window
and nothing else, and a cycle that is run again, or dies on the way, leaves the table
as one run does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.operators.bars import asset_joined, bars_between, dedup_bars, good_rows, tag_raw, type_bars
from barlens.sources.readers import window_before
from barlens.versioned import MergeTable

#: Days that a cycle loads again.
DELTA_DAYS = 15


def _latest(stored: DataFrame) -> DataFrame:
    return dedup_bars(stored.withColumn("_source_rank", F.col("_rank")))


def bar_store(spark: SparkSession, path: str) -> MergeTable:
    """Typed bars at ``path``, in parts of one frequency and week."""
    week = F.date_format(F.date_trunc("week", "transaction_date"), "yyyy-MM-dd")
    return MergeTable(spark, path, _latest, F.concat_ws("-", "frequency", week))


def typed(raw: DataFrame, frequency: str, rank: int) -> DataFrame:
    """Typed rows of one raw feed; ``rank`` decides between equal load times. The store keeps the
    latest of each bar when it merges, in the same order, so they are not shuffled for that
    before. A bar that does not parse fails the load."""
    return (good_rows(type_bars(tag_raw(raw, frequency, rank)), strict=True).drop("_source_rank")
            .withColumn("_rank", F.lit(rank)))


def weeks_of(lo: dt.date, hi: dt.date, frequency: str) -> Callable[[str], bool]:
    """Which parts hold bars of [lo, hi]."""
    first = lo - dt.timedelta(days=lo.weekday())
    keys = {f"{frequency}-{first + dt.timedelta(weeks=k)}" for k in range((hi - first).days // 7 + 1)}
    return keys.__contains__


def run_cycle(store: MergeTable, feed: DataFrame, instruments: DataFrame, as_of: str | dt.date,
              days: int = DELTA_DAYS, frequency: str = "daily", rank: int = 1) -> bool:
    """Load the window [as_of - days, as_of] of a raw ``feed`` for ``instruments`` (pair_id).
    False if this cycle is in the table already."""
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)      # a date that does not parse stops the cycle
    lo, hi = window_before(as_of, days)
    load_id = f"delta-{frequency}-{as_of}-{days}"
    if store.holds(load_id):
        return False
    mine = bars_between(feed, lo, hi, F.col("row_date_timestamp").cast("date")) \
        .join(instruments.select("pair_id").distinct(), "pair_id", "left_semi")
    parts = weeks_of(lo, hi, frequency)
    snap = store.snapshot()
    # rows of the window's weeks: what is stored, and what has come, the latest of each bar
    merged = _latest(store.latest(parts, snap.version).unionByName(typed(mine, frequency, rank)))
    return store.replace(merged, load_id, parts=parts)


def stock_data(store: MergeTable, assets: DataFrame) -> DataFrame:
    """MDL-3 from the stored bars."""
    return asset_joined(store.latest().drop("_rank"), assets)
