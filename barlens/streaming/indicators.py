"""ST-3 / ST-4 / ST-5: live indicators with Structured Streaming state.

Per instrument the processor keeps
  * ValueState ``ema``    - last position (event time, id), row count and
                            the last EMA 9/21/50;
  * ListState  ``window`` - the last (period - 1) values, in exact cents,
                            for the trailing-mean spike test.
Each micro-batch continues the series exactly where the previous one
stopped, so any split of the input into batches gives the same rows as one
batch run (and as the batch ``with_ema``). A row at or before the stored
position is *late*: it is emitted with ``late = true`` and no indicators,
and does not touch the state; ``with_rebuilt`` computes that instrument again.

State is O(1 + period) per instrument, whatever the stream length, and
Spark spreads instruments over tasks. The input is taken frame by frame; of a key's rows
in one micro-batch five numbers each are held to put them in order, and they come out
in slices. ``maxFilesPerTrigger`` bounds a micro-batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barlens.functions import crossover
from barlens.operators.ema import alpha, with_ema
from barlens.operators.indicators import EMA_PERIODS

#: Rows that leave the processor at a time.
SLICE = 20_000

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

EMA_STATE = T.StructType([
    T.StructField("last_t", T.LongType()),
    T.StructField("last_id", T.LongType()),
    T.StructField("n", T.LongType()),
] + [T.StructField(f"e{n}", T.DoubleType()) for n in EMA_PERIODS])
WINDOW_STATE = T.StructType([T.StructField("cents", T.LongType())])


def output_schema(key: str, time_col: str, id_col: str, value: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, T.LongType()),
        T.StructField(time_col, T.TimestampNTZType()),
        T.StructField(id_col, T.LongType()),
        T.StructField(value, T.DoubleType()),
        *[T.StructField(f"ema_{n}", T.DoubleType()) for n in EMA_PERIODS],
        *[T.StructField(f"prev_ema_{n}", T.DoubleType()) for n in EMA_PERIODS],
        T.StructField("ema_signal_9_21", T.StringType()),
        T.StructField("avg_value_30", T.DoubleType()),
        T.StructField("volume_status", T.StringType()),
        T.StructField("late", T.BooleanType()),
    ])


def _signal(f, s, pf, ps, strict):
    if pf is None or ps is None:
        return None
    if f > s and (pf < ps or not strict and pf == ps):
        return "BUY"
    if f < s and (pf > ps or not strict and pf == ps):
        return "SELL"
    return None


def _null(x):
    """NaN stands for NULL inside the recurrence."""
    return None if x is None or math.isnan(x) else x


class IndicatorProcessor(StatefulProcessor):
    """EMA 9/21/50 with lags and the 9/21 signal (``strict`` or accepting a touch), plus
    the trailing ``period``-row mean of the value and the spike flag.

    A NULL value makes the EMAs NULL from there on; in the trailing mean it takes up
    a row and counts for nothing, as in SQL's AVG."""

    def __init__(self, key: str, time_col: str, id_col: str, value: str,
                 period: int = 30, factor: float = 1.5, strict: bool = False):
        self.strict = strict
        self.key, self.time_col, self.id_col, self.value = key, time_col, id_col, value
        self.period, self.factor = period, factor
        self.names = [f.name for f in output_schema(key, time_col, id_col, value).fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ema = handle.getValueState("ema", EMA_STATE)
        self.window = handle.getListState("window", WINDOW_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # frame by frame; of each row only what the recurrence needs is kept to be put in order
        parts = [(f[self.time_col].astype("int64").to_numpy() // 1000, f[self.id_col].to_numpy("int64"),
                  f[self.value].to_numpy("float64"), f["value_cents"].fillna(0).to_numpy("int64"), f["value_cents"].isna().to_numpy())
                 for f in rows if len(f)]
        if not parts:
            return
        t_us, ids, xs, cents, missing = (np.concatenate(c) for c in zip(*parts))
        del parts
        order = np.lexsort((ids, t_us))
        # no value: the key is new
        stored = self.ema.get()
        if stored is not None:
            last_t, last_id, n, *es = stored
            emas = {p: math.nan if e is None else e for p, e in zip(EMA_PERIODS, es)}
        else:
            last_t, last_id, n, emas = None, None, 0, {p: None for p in EMA_PERIODS}
        ring = [r[0] for r in self.window.get()] if stored is not None else []
        for at in range(0, len(order), SLICE):
            part = order[at:at + SLICE]
            out = {c: [] for c in self.names}
            for t, i, x, c, gone in zip(t_us[part].tolist(), ids[part].tolist(), xs[part].tolist(), cents[part].tolist(),
                                        missing[part].tolist()):
                late = last_t is not None and (t, i) <= (last_t, last_id)
                out["late"].append(late)
                if late:
                    for p in EMA_PERIODS:
                        out[f"ema_{p}"].append(None)
                        out[f"prev_ema_{p}"].append(None)
                    out["ema_signal_9_21"].append(None)
                    out["avg_value_30"].append(None)
                    out["volume_status"].append(None)
                    continue
                prev = dict(emas)
                for p in EMA_PERIODS:
                    a = alpha(p)
                    emas[p] = x if emas[p] is None else x * a + emas[p] * (1.0 - a)
                    out[f"ema_{p}"].append(_null(emas[p]))
                    out[f"prev_ema_{p}"].append(_null(prev[p]))
                out["ema_signal_9_21"].append(_signal(emas[9], emas[21], prev[9], prev[21], self.strict))
                ring.append(None if gone else c)
                ring = ring[-self.period:]
                known = [v for v in ring if v is not None]
                avg = (sum(known) / 100) / len(known) if known else None
                out["avg_value_30"].append(avg)
                out["volume_status"].append(
                    "VOLUME SPIKE" if avg is not None and x > self.factor * avg else "NORMAL VOLUME")
                last_t, last_id, n = t, i, n + 1
            out[self.key] = [key[0]] * len(part)
            out[self.time_col] = t_us[part].astype("datetime64[us]")
            out[self.id_col] = ids[part]
            out[self.value] = [_null(x) for x in xs[part].tolist()]
            yield pd.DataFrame({c: out[c] for c in self.names})
        if last_t is not None:
            self.ema.update((last_t, last_id, n, *[_null(emas[p]) for p in EMA_PERIODS]))
            self.window.put([(v,) for v in ring[-(self.period - 1):]] if self.period > 1 else [])

    def close(self) -> None:
        pass


#: Settings that a query with ``stream_indicators`` must start with. A commit uploads what changed, not the
#: whole state; counting the state's rows would cost a look-up for every write.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
              "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def stream_indicators(df: DataFrame, key: str = "user_id", time_col: str = "ts",
                      id_col: str = "event_id", value: str = "value",
                      period: int = 30, factor: float = 1.5, strict: bool = False) -> DataFrame:
    """Attach live indicators to a (streaming or batch) frame of
    (key, time, id, value) rows. The query must start with ``STATE_CONF``."""
    prepared = df.select(
        F.col(key).cast("bigint").alias(key), F.col(time_col).cast("timestamp_ntz").alias(time_col),
        F.col(id_col).cast("bigint").alias(id_col), F.col(value).cast("double").alias(value),
        (F.col(value).cast("decimal(18,2)") * 100).cast("bigint").alias("value_cents"))
    proc = IndicatorProcessor(key, time_col, id_col, value, period, factor, strict)
    return (prepared.groupBy(key)
            .transformWithStateInPandas(proc, output_schema(key, time_col, id_col, value),
                                        "Append", "None"))


def with_rebuilt(out: DataFrame, landed: DataFrame, key: str = "user_id", time_col: str = "ts",
                 id_col: str = "event_id", value: str = "value", period: int = 30, factor: float = 1.5,
                 strict: bool = False) -> DataFrame:
    """ST-6: the stream's output with every key that got a late row rebuilt.

    ``out`` is what the stream has emitted, ``landed`` all rows landed so far. Only keys
    with late rows are computed again, in batch, by window functions and ``with_ema``;
    all other rows stay as emitted.
    """
    touched = out.filter(F.col("late")).select(key).distinct()
    rows = (landed.join(touched, key, "left_semi")
            .select(F.col(key).cast("bigint").alias(key), F.col(time_col).cast("timestamp_ntz").alias(time_col),
                    F.col(id_col).cast("bigint").alias(id_col), F.col(value).cast("double").alias(value))
            .withColumn("_at", F.struct(time_col, id_col)))
    w = Window.partitionBy(key).orderBy(time_col, id_col)
    rows = rows.withColumn("_seq", F.row_number().over(w)).drop("_at")
    ema = with_ema(rows, EMA_PERIODS, col=value, keys=(key,), order="_seq").drop("_seq")
    near = w.rowsBetween(1 - period, 0)
    money = F.col(value).cast("decimal(18,2)")
    avg = F.sum(money).over(near).cast("double") / F.when(F.count(money).over(near) > 0, F.count(money).over(near))
    done = (ema.withColumn("avg_value_30", avg)
            .withColumn("ema_signal_9_21", crossover("ema_9", "ema_21", "prev_ema_9", "prev_ema_21", strict))
            .withColumn("volume_status", F.when(F.col(value) > F.lit(factor) * F.col("avg_value_30"), "VOLUME SPIKE")
                        .otherwise("NORMAL VOLUME"))
            .withColumn("late", F.lit(False)))
    return out.join(touched, key, "left_anti").unionByName(done.select(*out.columns))
