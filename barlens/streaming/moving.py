"""ST-3 / WIN-8 / WIN-11 / MDL-5 on a stream: moving averages, their lags and crossover signals.

Per instrument the state holds the last position (event time, id) and the last
``max(periods) + 1`` running sums and counts of the value, in exact cents. The sum
of any frame is then a difference of two running sums, as in the batch
operator ``with_sma``: a row costs the same for every period, and the result is the same to
the last bit however the input is cut into batches.

A row at or before the stored position is *late*: it is emitted with ``late = true`` and
no averages, and doesn't touch the state; ``with_rebuilt_sma`` computes its instrument
again. A NULL value takes up a row of each frame and counts for nothing, as in SQL's AVG.

State is 16 bytes for each running pair (2.4 KB at 150 rows), whatever the length of the
stream. Of one micro-batch, a key's rows are held as four numbers each to be put in
order, and come out in slices; ``maxFilesPerTrigger`` bounds a micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barlens.operators.indicators import SMA_PERIODS, with_sma
from barlens.operators.signals import SMA_PAIRS, with_crossovers

STATE = T.StructType([
    T.StructField("last_t", T.LongType()),
    T.StructField("last_id", T.LongType()),
    T.StructField("sums", T.BinaryType()),
    T.StructField("counts", T.BinaryType()),
])
#: Rows that leave the processor at a time.
SLICE = 20_000


def sma_columns(periods=SMA_PERIODS, pairs=SMA_PAIRS) -> list[str]:
    return [*[f"sma_{n}" for n in periods], *[f"prev_sma_{n}" for n in periods], *[f"sma_signal_{a}_{b}" for a, b in pairs]]


def output_schema(key: str, time_col: str, id_col: str, value: str, periods=SMA_PERIODS, pairs=SMA_PAIRS) -> T.StructType:
    kinds = {"sma_signal": T.StringType()}
    return T.StructType([
        T.StructField(key, T.LongType()), T.StructField(time_col, T.TimestampNTZType()),
        T.StructField(id_col, T.LongType()), T.StructField(value, T.DoubleType()),
        *[T.StructField(c, kinds.get(c[:10], T.DoubleType())) for c in sma_columns(periods, pairs)],
        T.StructField("late", T.BooleanType())])


def frame_means(sums: np.ndarray, counts: np.ndarray, rows: int, n: int, back: int = 0) -> np.ndarray:
    """Means of the ``n`` rows that end ``back`` rows before each of the last ``rows`` ones, from running
    sums in cents and running counts; NaN where a frame holds no value."""
    end = np.arange(len(sums) - rows, len(sums)) - back
    total, seen = sums[end] - sums[end - n], counts[end] - counts[end - n]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(seen > 0, total / 100.0 / seen, np.nan)


def signals(fast: np.ndarray, slow: np.ndarray, prev_fast: np.ndarray, prev_slow: np.ndarray) -> np.ndarray:
    """BUY / SELL / None of strict crossings; NaN compares false, as NULL does."""
    out = np.full(len(fast), None, object)
    out[(fast > slow) & (prev_fast < prev_slow)] = "BUY"
    out[(fast < slow) & (prev_fast > prev_slow)] = "SELL"
    return out


class MovingAverageProcessor(StatefulProcessor):
    def __init__(self, names: list[str], periods=SMA_PERIODS, pairs=SMA_PAIRS):
        self.key, self.time_col, self.id_col, self.value = names
        self.periods, self.pairs = tuple(periods), tuple(pairs)
        self.depth = max(self.periods) + 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("sma", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [np.stack([f[self.time_col].astype("int64").to_numpy() // 1000, f[self.id_col].to_numpy(np.int64),
                           f["value_cents"].fillna(0).to_numpy(np.int64), f["value_cents"].notna().to_numpy(np.int64)])
                 for f in rows if len(f)]
        if not parts:
            return
        t, ids, cents, known = np.concatenate(parts, axis=1)
        del parts
        order = np.lexsort((ids, t))
        t, ids, cents, known = t[order], ids[order], cents[order], known[order]
        stored = self.state.get()
        if stored is not None:
            last_t, last_id, sums, counts = stored
            sums, counts = np.frombuffer(sums, np.int64), np.frombuffer(counts, np.int64)
            late = (t < last_t) | (t == last_t) & (ids <= last_id)
        else:
            sums = counts = np.zeros(self.depth, np.int64)
            late = np.zeros(len(t), bool)
        fresh = np.flatnonzero(~late)
        sums = np.concatenate([sums, sums[-1] + np.cumsum(cents[fresh])])
        counts = np.concatenate([counts, counts[-1] + np.cumsum(known[fresh])])
        if len(fresh):
            last = fresh[-1]
            self.state.update((int(t[last]), int(ids[last]), sums[-self.depth:].tobytes(), counts[-self.depth:].tobytes()))
        yield from self._rows(key[0], t[late], ids[late], cents[late], known[late])
        for at in range(0, len(fresh), SLICE):
            part = fresh[at:at + SLICE]
            upto = self.depth + at + len(part)
            yield from self._rows(key[0], t[part], ids[part], cents[part], known[part],
                                  sums[upto - len(part) - self.depth:upto], counts[upto - len(part) - self.depth:upto])

    def _rows(self, key, t, ids, cents, known, sums=None, counts=None) -> Iterator[pd.DataFrame]:
        if not len(t):
            return
        out = {self.key: np.full(len(t), key), self.time_col: t.astype("datetime64[us]"), self.id_col: ids,
               self.value: np.where(known > 0, cents / 100.0, np.nan)}
        for n in self.periods:
            out[f"sma_{n}"] = np.full(len(t), np.nan) if sums is None else frame_means(sums, counts, len(t), n)
        for n in self.periods:
            out[f"prev_sma_{n}"] = np.full(len(t), np.nan) if sums is None else frame_means(sums, counts, len(t), n, 1)
        for a, b in self.pairs:
            out[f"sma_signal_{a}_{b}"] = signals(*(out[f"{p}sma_{n}"] for p in ("", "prev_") for n in (a, b)))
        out["late"] = np.full(len(t), sums is None)
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def stream_sma(df: DataFrame, key: str = "user_id", time_col: str = "ts", id_col: str = "event_id", value: str = "value",
               periods=SMA_PERIODS, pairs=SMA_PAIRS) -> DataFrame:
    """Moving averages, lags and signals of a (streaming or batch) frame of (key, time, id, value) rows,
    values in cents. The query must start with ``streaming.indicators.STATE_CONF``."""
    prepared = df.select(
        F.col(key).cast("bigint").alias(key), F.col(time_col).cast("timestamp_ntz").alias(time_col),
        F.col(id_col).cast("bigint").alias(id_col), (F.col(value).cast("decimal(18,2)") * 100).cast("bigint").alias("value_cents"))
    names = [key, time_col, id_col, value]
    return (prepared.groupBy(key).transformWithStateInPandas(
        MovingAverageProcessor(names, periods, pairs), output_schema(*names, periods, pairs), "Append", "None"))


def with_rebuilt_sma(out: DataFrame, landed: DataFrame, key: str = "user_id", time_col: str = "ts", id_col: str = "event_id",
                     value: str = "value", periods=SMA_PERIODS, pairs=SMA_PAIRS) -> DataFrame:
    """ST-6: the stream's output with every key that got a late row computed again from all rows
    landed, in batch; all other rows stay as emitted."""
    touched = out.filter(F.col("late")).select(key).distinct()
    money = F.col(value).cast("decimal(18,2)")
    rows = (landed.join(touched, key, "left_semi")
            .select(F.col(key).cast("bigint").alias(key), F.col(time_col).cast("timestamp_ntz").alias(time_col),
                    F.col(id_col).cast("bigint").alias(id_col), money.alias("_money")))
    done = with_crossovers(with_sma(rows, periods, "_money", keys=(key,), order=f"{time_col}, {id_col}", prev=True), "sma", pairs)
    done = done.withColumn(value, F.col("_money").cast("double")).withColumn("late", F.lit(False))
    return out.join(touched, key, "left_anti").unionByName(done.select(*out.columns))
