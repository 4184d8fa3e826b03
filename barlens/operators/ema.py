"""EMA-1 / EMA-2: exponential moving averages.

    e(1) = x(1);   e(n) = x(n) * a + e(n-1) * (1 - a),   a = 2 / (N + 1)

This is an ordered recurrence, which no built-in window function expresses
in linear time. The rows of a series are numbered by an ordinary window
(``row_number``), which brings them together and in order and shares its shuffle and
sort with the other windows of the series; ``mapInArrow`` then reads the ordered
rows batch by batch and carries the last EMAs from row to row and from batch to
batch. A task holds one Arrow batch and a few numbers, however long a series is.
Only the close is converted to numbers; every other column passes through as Arrow data
untouched.

The recurrence is evaluated step by step in the order written above, so the
result is bit-identical to the same recurrence written in SQL. A NULL close
makes that EMA NULL from there on, as SQL arithmetic does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlens.operators.indicators import EMA_PERIODS, ORDER_COL, SERIES_KEYS

#: Helper columns: the input, the row's number in its series, whether the recurrence starts there,
#: whether it passes the row by.
_X, _SEQ, _NEW, _LATE = "_ema_input", "_ema_seq", "_ema_new", "_ema_late"
_HELPERS = (_X, _SEQ, _NEW, _LATE)


def alpha(n: int) -> float:
    return 2.0 / (n + 1)


def ema_path(xs: list, a: float, seed: float | None = None) -> list:
    """The recurrence over ``xs`` (floats, NaN for NULL).

    seed=None starts the series at x(1); a seed continues an earlier series.
    """
    out = [0.0] * len(xs)
    b = 1.0 - a
    e = seed
    for i, v in enumerate(xs):
        e = v if e is None else v * a + e * b
        out[i] = e
    return out


def _ema_columns(periods, prev: bool) -> list[str]:
    cols = [f"ema_{n}" for n in periods]
    if prev:
        cols += [f"prev_ema_{n}" for n in periods]
    return cols


def _seed(n: int) -> str:
    return f"_ema_seed_{n}"


def _recur(batches: Iterator[pa.RecordBatch], periods: tuple, names: list[str], prev: bool) -> Iterator[pa.RecordBatch]:
    """Ordered rows with the helper columns -> columns ``names``. The EMAs of the row before
    are all that is kept between rows."""
    carry: list = [None] * len(periods)
    last = 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        def column(name):
            return batch.column(batch.schema.get_field_index(name))
        seq = column(_SEQ).to_numpy()
        before = np.concatenate([[last], seq[:-1]])
        if ((seq != 1) & (seq != before + 1)).any():
            raise ValueError("the rows of a series are not together and in order")
        last = seq[-1]
        new, late = (column(c).to_numpy(zero_copy_only=False).astype(bool) for c in (_NEW, _LATE))
        xs = column(_X).to_numpy(zero_copy_only=False).astype(float).tolist()
        seeds = {p: column(_seed(p)) for p in periods if batch.schema.get_field_index(_seed(p)) >= 0}
        cuts = np.flatnonzero(new | np.concatenate([[True], late[1:] != late[:-1]])).tolist()
        now, was = np.full((len(periods), n), np.nan), np.full((len(periods), n), np.nan)
        for a, b in zip(cuts, [*cuts[1:], n]):
            if late[a]:
                continue
            for k, p in enumerate(periods):
                if new[a]:
                    # NaN is a stored NULL: the series goes on as NULL, it doesn't start again
                    carry[k] = seeds[p][a].as_py() if p in seeds else None
                path = ema_path(xs[a:b], alpha(p), carry[k])
                now[k, a:b] = path
                was[k, a] = np.nan if carry[k] is None else carry[k]
                was[k, a + 1:b] = path[:-1]
                carry[k] = path[-1]
        made = {f"ema_{p}": pa.array(now[k], from_pandas=True) for k, p in enumerate(periods)}
        if prev:
            made |= {f"prev_ema_{p}": pa.array(was[k], from_pandas=True) for k, p in enumerate(periods)}
        made["late"] = pa.array(late)
        yield pa.RecordBatch.from_arrays([made[c] if c in made else column(c) for c in names], names=names)


def _recurrence(rows: DataFrame, keys, order: list, periods: tuple, prev: bool, extra: tuple = ()) -> DataFrame:
    """``rows`` (with ``_X``, ``_LATE`` and, where series go on, seeds) through the recurrence."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(_LATE).over(w)
    rows = (rows.withColumn(_SEQ, F.row_number().over(w))
            .withColumn(_NEW, ~F.col(_LATE) & F.coalesce(before, F.lit(True))))
    helpers = {*_HELPERS, *(_seed(n) for n in periods)}
    schema = T.StructType([f for f in rows.schema.fields if f.name not in helpers]
                          + [T.StructField(c, T.DoubleType()) for c in _ema_columns(periods, prev)]
                          + [T.StructField(c, T.BooleanType()) for c in extra])
    names = schema.fieldNames()
    # the window has sorted them already: no second sort is planned
    ordered = rows.sortWithinPartitions(*keys, *order)
    return ordered.mapInArrow(lambda it: _recur(it, periods, names, prev), schema)


def with_ema(df: DataFrame, periods=EMA_PERIODS, col: str = "last_close",
             keys=SERIES_KEYS, order: str = ORDER_COL, prev: bool = True) -> DataFrame:
    """Add ``ema_<n>`` (and ``prev_ema_<n>``, the previous row's EMA) columns."""
    base = df.withColumn(_X, F.col(col).cast("double")).withColumn(_LATE, F.lit(False))
    return _recurrence(base, keys, [F.col(order)], tuple(periods), prev)


# --- EMA-2: resume from stored state --------------------------------------

STATE_SCHEMA = T.StructType([
    T.StructField("pair_id", T.LongType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("last_date", T.DateType()),
    T.StructField("n_rows", T.LongType()),
] + [T.StructField(f"ema_{n}", T.DoubleType()) for n in EMA_PERIODS])


def ema_state(ema_rows: DataFrame, periods=EMA_PERIODS, keys=SERIES_KEYS,
              order: str = ORDER_COL) -> DataFrame:
    """Per-series state after the last row: last date, row count, last EMAs.

    Built with aggregates (max_by), so it is a partial/final aggregation."""
    return (ema_rows.groupBy(*keys)
            .agg(F.max(order).alias("last_date"),
                 F.count(F.lit(1)).alias("n_rows"),
                 *[F.max_by(f"ema_{n}", order).alias(f"ema_{n}") for n in periods]))


def ema_resume(new_rows: DataFrame, state: DataFrame, periods=EMA_PERIODS,
               col: str = "last_close", keys=SERIES_KEYS,
               order: str = ORDER_COL) -> DataFrame:
    """Continue each series from ``state`` over ``new_rows``.

    Output = the new rows with ``ema_<n>``, ``prev_ema_<n>`` (the first new
    row's previous EMA is the stored one) and ``late``: True for a row dated
    on or before the stored last date. Late rows get NULL EMAs; they mean the
    series must be rebuilt (``rebuild_series``), since a corrected old bar
    changes every later EMA.
    A series without state starts fresh, exactly like ``with_ema``. The state is
    joined to the rows; each series reads its seeds from its first new row.
    """
    periods = tuple(periods)
    seeds = state.select(*[F.col(k).alias(f"_state_{k}") for k in keys], F.col("last_date").alias("_state_date"),
                         *[F.coalesce(F.col(f"ema_{n}"), F.lit(float("nan"))).alias(_seed(n)) for n in periods])
    same = [F.col(k).eqNullSafe(F.col(f"_state_{k}")) for k in keys]
    base = (new_rows.join(seeds, same, "left")
            .withColumn(_X, F.col(col).cast("double"))
            .withColumn(_LATE, F.coalesce(F.col(order) <= F.col("_state_date"), F.lit(False)))
            .drop(*[f"_state_{k}" for k in keys], "_state_date"))
    return _recurrence(base, keys, [F.col(_LATE).desc(), F.col(order)], periods, True, ("late",))


def rebuild_series(bars: DataFrame, late_rows: DataFrame, periods=EMA_PERIODS,
                   keys=SERIES_KEYS) -> DataFrame:
    """Recompute whole series for instruments that received late bars."""
    touched = late_rows.select(*keys).distinct()
    return with_ema(bars.join(touched, list(keys), "left_semi"), periods, keys=keys)


def apply_delivery(history: DataFrame, state: DataFrame, delivered: DataFrame,
                   bars: DataFrame, periods=EMA_PERIODS, keys=SERIES_KEYS) -> DataFrame:
    """Corrected incremental EMA table after one delivery of bars (ST-6).

    history   - the current EMA rows (``with_ema`` output, narrow or wide)
    state     - ``ema_state`` of ``history``
    delivered - the new or corrected bars of this load
    bars      - every bar after the load (used only for touched series)

    Series whose delivery holds a bar on or before their stored last date
    (a correction or a late bar), or that have no state yet, are rebuilt
    from ``bars``; every other series that is still in ``bars`` keeps its history
    and continues from its state; series that left ``bars`` go. The result equals
    recomputing the whole table from ``bars``, while only the touched series are
    read in full.

    Which series are touched comes from one small aggregate of the delivery
    against the state, so each of the two Python passes (resume, rebuild) runs
    once and only over its own series.
    """
    keys = list(keys)
    cols = history.columns
    live = bars.select(*keys).distinct()
    firsts = delivered.groupBy(*keys).agg(F.min(ORDER_COL).alias("_first"))
    touched = (firsts.join(state.select(*keys, "last_date"), keys, "left")
               .filter(F.col("last_date").isNull() | (F.col("_first") <= F.col("last_date"))).select(*keys))
    rebuilt = with_ema(bars.join(touched, keys, "left_semi"), periods, keys=keys)
    kept = history.join(live, keys, "left_semi").join(touched, keys, "left_anti")
    resumed = ema_resume(delivered.join(touched, keys, "left_anti"), state, periods, keys=keys)
    return kept.select(*cols).unionByName(resumed.select(*cols)).unionByName(rebuilt.select(*cols))
