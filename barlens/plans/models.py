"""The reference's datasets (MDL-3 .. MDL-11) as composed DataFrame plans.

Each function takes DataFrames and returns a DataFrame, so a whole chain
(unify -> indicators -> signals -> trades) is one logical plan that Catalyst
optimises end to end. Tables are written only where a caller chooses to
(``barlens.sinks``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlens.functions import cap_bucket, crossover
from barlens.operators.bars import unify_bars, unique_assets
from barlens.operators.compare import compare_strategies
from barlens.operators.ema import with_ema
from barlens.operators.indicators import (EMA_PERIODS, MIN_AVG_VOLUME, SMA_PERIODS,
                                          daily_liquid_bars, with_sma)
from barlens.operators.signals import (EMA_PAIRS, EMA_TRADED, SMA_PAIRS, SMA_TRADED,
                                       with_crossovers)
from barlens.operators.trades import PNL_COLUMNS, TRADE_COLUMNS, pair_trades
from barlens.schemas import BAR_ATTRIBUTES

INDICATOR_BASE = [*BAR_ATTRIBUTES, "transaction_id", "transaction_date", "volume",
                  "last_min", "last_max", "last_open", "last_close"]


def stock_data(feeds: dict[str, DataFrame], tasks: int | None = None) -> DataFrame:
    """MDL-3 from the four raw feeds and the asset master. A raw bar that does not
    parse fails the job, so no series is shortened in silence. ``tasks``: see ``unify_bars``."""
    return unify_bars(feeds["historical_daily"], feeds["historical_weekly"], feeds["current_daily"],
                      feeds["current_weekly"], feeds["assets"], strict=True, tasks=tasks)[0]


def stock_data_and_quarantine(feeds: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """MDL-3 for feeds that may hold bad rows: (the table, the rows left out with their
    reasons). Callers land both."""
    return unify_bars(feeds["historical_daily"], feeds["historical_weekly"], feeds["current_daily"],
                      feeds["current_weekly"], feeds["assets"])


def sma_strategy(stock: DataFrame, min_avg_volume: float = MIN_AVG_VOLUME,
                 periods=SMA_PERIODS) -> DataFrame:
    """MDL-4: daily bars of liquid instruments with SMAs and their lags."""
    bars = daily_liquid_bars(stock, min_avg_volume).select(
        *BAR_ATTRIBUTES, "transaction_id", "quarter_start", "transaction_date", "volume",
        "last_min", "last_max", "last_open", "last_close")
    return with_sma(bars, periods, prev=True)


def sma_crossover(sma: DataFrame, pairs=SMA_PAIRS) -> DataFrame:
    """MDL-5."""
    return with_crossovers(sma, "sma", pairs)


def sma_backtest(cross: DataFrame, strategies=SMA_TRADED, collapse: bool = True) -> DataFrame:
    """MDL-6: closed trades of four SMA strategies, keeping the rank column."""
    return pair_trades(cross, strategies, collapse=collapse, keep_rank=collapse)


def ema_strategy(stock: DataFrame, min_avg_volume: float = MIN_AVG_VOLUME,
                 periods=EMA_PERIODS, columns=INDICATOR_BASE) -> DataFrame:
    """MDL-7: daily bars of liquid instruments with EMAs and their lags. ``columns`` are
    all that goes through the grouped Arrow call, which Catalyst cannot prune."""
    bars = daily_liquid_bars(stock, min_avg_volume).select(*columns)
    return with_ema(bars, periods)


def ema_crossover(ema: DataFrame, pairs=EMA_PAIRS) -> DataFrame:
    """MDL-8 signals."""
    return with_crossovers(ema, "ema", pairs)


def ema_backtest(cross: DataFrame, strategies=EMA_TRADED) -> DataFrame:
    """MDL-8 trades (no rank column in the reference's output)."""
    return pair_trades(cross, strategies, collapse=True, keep_rank=False)


#: What an EMA trade is made from; instrument attributes join the trades, not the bars.
TRADE_BASE = ["pair_id", "ticker", "transaction_date", "volume", "last_close"]


def asset_attributes(assets: DataFrame) -> DataFrame:
    """The instrument columns of trades, one row per pair_id."""
    return unique_assets(assets).withColumn("market_cap_category", cap_bucket("market_cap")).select(*BAR_ATTRIBUTES)


def ema_trades(stock: DataFrame, assets: DataFrame, min_avg_volume: float = MIN_AVG_VOLUME,
               strategies=EMA_TRADED) -> DataFrame:
    """MDL-8 from the unified bars: the same trades as ``ema_backtest`` over
    ``ema_crossover`` over ``ema_strategy``, with five narrow columns through both
    shuffles and the Arrow call, and the attributes joined to the few trades."""
    cross = ema_crossover(ema_strategy(stock, min_avg_volume, columns=TRADE_BASE))
    trades = pair_trades(cross, strategies, attributes=["pair_id", "ticker"])
    more = asset_attributes(assets).drop("ticker")
    return trades.join(more, "pair_id").select(*TRADE_COLUMNS, *PNL_COLUMNS)


INCREMENTAL_COLUMNS = ["pair_id", "ticker", "stock_name", "transaction_date",
                       "ema_9", "ema_21", "ema_50", "prev_ema_9", "prev_ema_21",
                       "crossover_signal"]


def ema_incremental(stock: DataFrame, after: dt.date | Column | None = None,
                    min_avg_volume: float = MIN_AVG_VOLUME) -> DataFrame:
    """MDL-9 as the reference runs it: when ``after`` is given (the target's
    global high-water mark, a date or ``high_water`` of the target), only bars after it are processed and every
    series re-seeds at its first new bar (Q-4, Q-5). The 9/21 signal is the
    loose form (Q-3)."""
    bars = daily_liquid_bars(stock, min_avg_volume)
    if after is not None:
        bars = bars.filter(F.col("transaction_date") > (after if isinstance(after, Column) else F.lit(after)))
    ema = with_ema(bars.select("pair_id", "ticker", "stock_name", "transaction_date",
                               "last_close"), EMA_PERIODS)
    return ema.withColumn(
        "crossover_signal",
        crossover("ema_9", "ema_21", "prev_ema_9", "prev_ema_21", strict=False),
    ).select(*INCREMENTAL_COLUMNS)


def high_water(target: DataFrame, col: str = "transaction_date") -> Column:
    """AGG-3/FLT-7: the target's global max date, as a scalar subquery of the plan it is used in."""
    return target.agg(F.max(col)).scalar()


def strategy_compare(sma_trades: DataFrame, ema_trades: DataFrame) -> DataFrame:
    """MDL-11."""
    return compare_strategies(ema_trades, sma_trades)
