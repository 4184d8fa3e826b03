"""The scalar rules of ``barlens.functions`` as Spark SQL expression text.

Operators that build wide projections write them as one SQL statement
(``spark.sql(text, src=df)``): the JVM parses the whole statement at once,
instead of the driver assembling every expression node one by one. Each
builder here mirrors a Column function in ``scalar.py`` / ``money.py``;
``tests/test_functions.py`` checks that both give the same values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame

from barlens.functions.money import NOTIONAL
from barlens.functions.scalar import (LARGE_CAP_ABOVE, MICRO_CAP_BELOW, MID_CAP_RANGE,
                                      SMALL_CAP_RANGE)


def run_sql(text: str, **frames: DataFrame) -> DataFrame:
    """``spark.sql`` over DataFrames referenced as ``{name}`` in ``text``."""
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(text, **frames)


def parse_price(col: str) -> str:
    return f"TRY_CAST(REPLACE(TRIM({col}), ',', '') AS DECIMAL(10,4))"


def parse_count(col: str) -> str:
    return f"TRY_CAST(TRY_CAST(REPLACE(TRIM({col}), ',', '') AS DECIMAL(38,4)) AS BIGINT)"


def cap_bucket(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN 'Unknown' "
            f"WHEN {col} > {LARGE_CAP_ABOVE} THEN 'Large Cap' "
            f"WHEN {col} BETWEEN {MID_CAP_RANGE[0]} AND {MID_CAP_RANGE[1]} THEN 'Mid Cap' "
            f"WHEN {col} BETWEEN {SMALL_CAP_RANGE[0]} AND {SMALL_CAP_RANGE[1]} THEN 'Small Cap' "
            f"WHEN {col} < {MICRO_CAP_BELOW} THEN 'Micro Cap' ELSE 'Other' END")


def crossover(fast: str, slow: str, prev_fast: str, prev_slow: str, strict: bool = True) -> str:
    lt, gt = ("<", ">") if strict else ("<=", ">=")
    return (f"CASE WHEN {fast} > {slow} AND {prev_fast} {lt} {prev_slow} THEN 'BUY' "
            f"WHEN {fast} < {slow} AND {prev_fast} {gt} {prev_slow} THEN 'SELL' END")


def double(x: float) -> str:
    return f"{float(x)!r}D"


def pnl(buy: str = "buy_price", sell: str = "sell_price", notional: Decimal = NOTIONAL) -> list[str]:
    n = str(Decimal(notional))
    shares = f"TRY_DIVIDE({n}BD, {buy})"
    return [f"ROUND({shares}, 2) AS shares_bought",
            f"ROUND({shares} * {sell} - {n}BD, 2) AS profit_or_loss",
            f"ROUND(TRY_DIVIDE({sell} - {buy}, {buy}) * 100, 2) AS percent_profit_loss"]


def frame_mean(total: str, count: str, n: int, window: str, back: int = 0) -> str:
    """Mean of the ``n`` rows ending ``back`` rows before the current one,
    from running total/count columns (see ``operators.indicators``)."""
    def at(c: str, k: int) -> str:
        return c if k == 0 else f"LAG({c}, {k}) OVER {window}"
    s = f"COALESCE({at(total, back)}, 0) - COALESCE({at(total, back + n)}, 0)"
    c = f"COALESCE({at(count, back)}, 0) - COALESCE({at(count, back + n)}, 0)"
    return f"TRY_DIVIDE(CAST({s} AS DOUBLE), {c})"
