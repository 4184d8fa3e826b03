"""MDL-5 / MDL-8 signal columns: crossovers of indicator pairs (PRJ-6/7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barlens.functions import sqlexpr as X
from barlens.functions.sqlexpr import run_sql

# The (fast, slow) pairs the reference derives signals for.
SMA_PAIRS = ((5, 15), (5, 21), (9, 21), (9, 50), (21, 50), (50, 150))
EMA_PAIRS = ((9, 21), (21, 50))
# ... and the subsets it turns into trades.
SMA_TRADED = ("sma_signal_5_15", "sma_signal_9_21", "sma_signal_21_50", "sma_signal_50_150")
EMA_TRADED = ("ema_signal_9_21", "ema_signal_21_50")


def with_crossovers(df: DataFrame, kind: str, pairs, strict: bool = True) -> DataFrame:
    """Add ``<kind>_signal_<fast>_<slow>`` for each pair. Needs the indicator
    columns ``<kind>_<n>`` and their ``prev_<kind>_<n>`` lags."""
    sigs = ", ".join(
        f"{X.crossover(f'{kind}_{f}', f'{kind}_{s}', f'prev_{kind}_{f}', f'prev_{kind}_{s}', strict)}"
        f" AS {kind}_signal_{f}_{s}" for f, s in pairs)
    return run_sql(f"SELECT *, {sigs} FROM {{src}}", src=df)
