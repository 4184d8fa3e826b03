"""Per-instrument indicators: sequence numbers, SMAs and their lags, liquidity,
volume spikes (EMAs are in ``ema.py``).

Every window here uses the same partitioning, ``(pair_id, ticker)`` ordered
by ``transaction_date``, so all of them share one shuffle and one sort.
A series holds at most one bar per instrument, frequency and calendar day
(``unify_bars`` guarantees it), so one series is bounded by the calendar
(~260 trading days a year) however large the whole table grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlens.functions import sqlexpr as X
from barlens.functions.sqlexpr import run_sql

SERIES_KEYS = ("pair_id", "ticker")
ORDER_COL = "transaction_date"

# The reference's indicator periods and liquidity threshold.
SMA_PERIODS = (5, 9, 15, 21, 50, 150)
EMA_PERIODS = (9, 21, 50)
MIN_AVG_VOLUME = 500000


def series_window(keys=SERIES_KEYS, order: str = ORDER_COL) -> Window:
    return Window.partitionBy(*keys).orderBy(order)


def with_seq(df: DataFrame, name: str = "seq_num", keys=SERIES_KEYS) -> DataFrame:
    """WIN-2: 1-based position in the series."""
    return df.withColumn(name, F.row_number().over(series_window(keys)))


def _series_clause(keys, order: str = ORDER_COL) -> str:
    return f"PARTITION BY {', '.join(keys)} ORDER BY {order}"


def with_sma(df: DataFrame, periods=SMA_PERIODS, col: str = "last_close",
             prefix: str = "sma_", keys=SERIES_KEYS, prev: bool = False, order: str = ORDER_COL) -> DataFrame:
    """WIN-8 (+ WIN-11 when ``prev``): moving averages of ``col`` over row
    frames, and each one's previous-row value ``prev_<prefix><n>``. ``order``: the column or,
    separated by commas, columns that order a series.

    Spark re-aggregates a moving ROWS frame for every row (O(n) per row), so
    each frame sum is a difference of running sums instead: one running
    SUM/COUNT (O(1) per row) and O(1) ``lag``s. The sums are exact (DECIMAL
    or BIGINT), so the difference equals the frame sum exactly, and it is
    divided once.

    All periods share one running sum and count (``sqlexpr.frame_mean``); the
    previous row's mean comes from the same running columns shifted by one,
    which is exactly ``lag(mean)`` (NULL on the first row) without another
    window pass.
    """
    w = f"({_series_clause(keys, order)})"
    cols = [f"{X.frame_mean('_rs', '_rc', n, w)} AS {prefix}{n}" for n in periods]
    if prev:
        cols += [f"{X.frame_mean('_rs', '_rc', n, w, back=1)} AS prev_{prefix}{n}" for n in periods]
    keep = ", ".join(df.columns)
    return run_sql(f"""
        SELECT {keep}, {', '.join(cols)} FROM (
          SELECT *, SUM({col}) OVER r AS _rs, COUNT({col}) OVER r AS _rc FROM {{src}}
          WINDOW r AS ({_series_clause(keys, order)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
                   src=df)


def with_prev(df: DataFrame, cols, prefix: str = "prev_", keys=SERIES_KEYS) -> DataFrame:
    """WIN-11/12: previous row's value of each column."""
    w = series_window(keys)
    return df.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in cols})


def liquid(stock_data: DataFrame, min_avg_volume: float = MIN_AVG_VOLUME,
           frequency: str = "daily") -> DataFrame:
    """AGG-1 + FLT-3: instruments whose mean volume over the whole history
    exceeds the threshold. One row per pair_id."""
    return (stock_data.filter(F.col("frequency") == frequency)
            .groupBy("pair_id")
            .agg((F.sum("volume").cast("double") / F.count("volume")).alias("avg_volume"))
            .filter(F.col("avg_volume") > F.lit(float(min_avg_volume))))


def daily_liquid_bars(stock_data: DataFrame, min_avg_volume: float = MIN_AVG_VOLUME,
                      keys=SERIES_KEYS) -> DataFrame:
    """FLT-1 + AGG-1 + FLT-3 + JN-3: daily bars of liquid instruments.

    Same rows as ``daily.join(liquid(...), "pair_id", "left_semi")``, but the
    whole-history mean is a window over the series partition (a series has a
    single ticker), ordered like the indicator windows: it rides on the
    shuffle and sort those need anyway, instead of scanning the bars a second
    time for an aggregate and joining it back.
    """
    keep = ", ".join(stock_data.columns)
    return run_sql(f"""
        SELECT {keep} FROM (
          SELECT *, CAST(SUM(volume) OVER a AS DOUBLE) / COUNT(volume) OVER a AS _avg_volume
          FROM {{src}} WHERE frequency = 'daily'
          WINDOW a AS ({_series_clause(keys)}
                       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
        WHERE _avg_volume > {X.double(min_avg_volume)}""", src=stock_data)


def volume_spikes(stock_data: DataFrame, period: int = 30, factor: float = 1.5,
                  frequency: str = "daily", keys=SERIES_KEYS) -> DataFrame:
    """MDL-10: bars whose volume exceeds ``factor`` x the trailing mean
    (current row included). No liquidity filter, like the reference."""
    w = f"({_series_clause(keys)})"
    avg_name = f"avg_volume_{period}"
    return run_sql(f"""
        SELECT *, 'VOLUME SPIKE' AS volume_status FROM (
          SELECT pair_id, ticker, stock_name, transaction_date, volume,
                 {X.frame_mean('_rs', '_rc', period, w)} AS {avg_name} FROM (
            SELECT *, SUM(volume) OVER r AS _rs, COUNT(volume) OVER r AS _rc
            FROM {{src}} WHERE frequency = '{frequency}'
            WINDOW r AS ({_series_clause(keys)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))
        WHERE volume > {X.double(factor)} * {avg_name}""", src=stock_data)
