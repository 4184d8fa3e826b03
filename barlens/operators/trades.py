"""MDL-6 / MDL-8 trades: pair every BUY with the next SELL of the same
instrument and strategy, then price the round trip.

The reference joins each BUY to every later SELL (a theta self-join) and
keeps the earliest. Here one window pass over the bar rows, ordered by date
descending with a running frame, carries "the nearest later SELL" of every
strategy down to each row: linear per series, no join, no pairs emitted.
The window is keyed like the indicator windows, so it reuses their shuffle.
Collapsing strategies that bought on the same day (the reference keeps the
one that sells first) is then a per-row minimum over a small array.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from barlens.functions import sqlexpr as X
from barlens.functions.sqlexpr import run_sql
from barlens.functions.money import NOTIONAL
from barlens.operators.indicators import SERIES_KEYS
from barlens.schemas import BAR_ATTRIBUTES

TRADE_COLUMNS = [
    *BAR_ATTRIBUTES, "buy_date", "sell_date", "volume", "buy_price", "sell_price",
    "buy_year", "sell_year", "status", "strategy",
]
PNL_COLUMNS = ["shares_bought", "profit_or_loss", "percent_profit_loss"]


# Orders open trades (no sell date) after closed ones when collapsing.
_NO_SELL = dt.date(9999, 12, 31)


def pair_trades(df: DataFrame, signal_cols, collapse: bool = True,
                include_open: bool = False, keep_rank: bool = False,
                notional=NOTIONAL, attributes=BAR_ATTRIBUTES) -> DataFrame:
    """Round-trip trades with P&L, from a frame with one row per bar and one
    BUY/SELL/NULL column per strategy.

    collapse: like the reference, keep one trade per (instrument, buy day)
      across strategies - the one with the earliest sell; ties go to the
      smaller strategy name.
    include_open: keep BUYs that never sold (status OPEN, NULL sell side).
    keep_rank: add the reference's collapse rank ``rn`` (always 1 here).
    attributes: instrument columns to carry; the series keys at least.
    """
    signal_cols = list(signal_cols)
    attrs = ", ".join(attributes)
    keys = ", ".join(SERIES_KEYS)
    nexts = ", ".join(
        f"last(CASE WHEN {c} = 'SELL' THEN named_struct('d', transaction_date, 'p', last_close) END,"
        f" true) OVER later AS _next_{i}" for i, c in enumerate(signal_cols))
    cands = ", ".join(
        f"CASE WHEN {c} = 'BUY' THEN named_struct("
        f"'k', coalesce(_next_{i}.d, DATE '{_NO_SELL.isoformat()}'), 'strategy', '{c}', "
        f"'sell_date', _next_{i}.d, 'sell_price', _next_{i}.p) END" for i, c in enumerate(signal_cols))
    keep = "x IS NOT NULL" + ("" if include_open else " AND x.sell_date IS NOT NULL")
    pick = "array_min(_c)" if collapse else "explode(_c)"
    rn = ", 1 AS rn" if collapse and keep_rank else ""
    return run_sql(f"""
        SELECT {attrs}, buy_date, sell_date, volume, buy_price, sell_price, buy_year, sell_year,
               status, strategy{rn}, {', '.join(X.pnl('buy_price', 'sell_price', notional))}
        FROM (
          SELECT {attrs}, transaction_date AS buy_date, _t.sell_date AS sell_date, volume,
                 last_close AS buy_price, _t.sell_price AS sell_price,
                 date_format(transaction_date, 'yyyy') AS buy_year,
                 date_format(_t.sell_date, 'yyyy') AS sell_year,
                 CASE WHEN _t.sell_date IS NOT NULL THEN 'CLOSED' ELSE 'OPEN' END AS status,
                 _t.strategy AS strategy
          FROM (
            SELECT *, {pick} AS _t FROM (
              SELECT {attrs}, transaction_date, volume, last_close,
                     filter(array({cands}), x -> {keep}) AS _c
              FROM (
                SELECT {attrs}, transaction_date, volume, last_close, {', '.join(signal_cols)},
                       {nexts}
                FROM {{src}}
                WINDOW later AS (PARTITION BY {keys} ORDER BY transaction_date DESC
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
            WHERE size(_c) > 0))""", src=df)
