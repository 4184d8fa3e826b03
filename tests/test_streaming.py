import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from barlens.operators.ema import with_ema
from barlens.session import scratch_path
from barlens.streaming.bars import latest_view, run_available_now, stream_bars, upsert_latest
from barlens.streaming.indicators import STATE_CONF, IndicatorProcessor, stream_indicators, with_rebuilt
from barlens.streaming.moving import MovingAverageProcessor
from helpers import T0, raw_rows

COLS = ["user_id", "event_id", "ema_9", "ema_21", "ema_50", "prev_ema_9", "avg_value_30", "late"]


def _events(spark, n=300, users=4, seed=1):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=i), rnd.randrange(users), round(rnd.uniform(1, 99), 2))
            for i in range(n)]
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, value double")


def _run(spark, batches):
    base = scratch_path(spark, "test-stream")
    landing, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/ck"
    schema = batches[0].schema
    for b in batches:
        b.write.mode("append").parquet(landing)
        run_available_now(stream_indicators(spark.readStream.schema(schema).parquet(landing))
                          .writeStream.format("parquet").option("path", out)
                          .option("checkpointLocation", ckpt).outputMode("append"), spark=spark, conf=STATE_CONF)
    return spark.read.parquet(out)


def test_null_value_then_second_batch(spark):
    """A gap makes the EMAs NULL for good, is skipped by the mean, and the next batch goes on."""
    t0 = dt.datetime(2024, 1, 1)
    values = [0.0, 1.0, 2.0, None, 4.0, 5.0, 60.0]
    ev = spark.createDataFrame([(i, t0 + dt.timedelta(minutes=i), 1, v) for i, v in enumerate(values)],
                               "event_id bigint, ts timestamp_ntz, user_id bigint, value double")
    out = _run(spark, [ev.filter("event_id < 5"), ev.filter("event_id >= 5")]).orderBy("event_id").collect()
    assert [r.ema_9 is None for r in out] == [False, False, False, True, True, True, True]
    means = [sum(v for v in values[:i + 1] if v is not None) / sum(v is not None for v in values[:i + 1]) for i in range(7)]
    assert [r.avg_value_30 for r in out] == means
    assert [r.volume_status for r in out][3:] == ["NORMAL VOLUME", "VOLUME SPIKE", "VOLUME SPIKE", "VOLUME SPIKE"]


def test_late_rows_are_rebuilt(spark):
    ev = _events(spark, n=200, users=3)
    late = ev.filter("user_id = 1 and event_id % 9 = 2")
    rest = ev.join(late, "event_id", "left_anti").select(*ev.columns)
    out = _run(spark, [rest, late])
    assert out.filter("late").count() == late.count() > 0
    whole = _run(spark, [ev])
    assert sorted(with_rebuilt(out, ev).collect()) == sorted(whole.collect())


def test_signal_forms():
    from barlens.streaming.indicators import _signal
    assert _signal(2, 1, 1, 1, False) == "BUY" and _signal(2, 1, 1, 1, True) is None
    assert _signal(1, 2, 1, 1, False) == "SELL" and _signal(1, 2, 2, 1, True) == "SELL"
    assert _signal(1, 2, None, 1, False) is None and _signal(float("nan"), 2, 3, 1, False) is None


def test_two_batches_equal_one_batch_and_batch_ema(spark):
    ev = _events(spark)
    one = _run(spark, [ev])
    two = _run(spark, [ev.filter("event_id < 150"), ev.filter("event_id >= 150")])
    assert sorted(one.select(COLS).collect()) == sorted(two.select(COLS).collect())
    batch = with_ema(ev.withColumnRenamed("user_id", "pair_id").withColumn("ticker", F.lit("t"))
                     .withColumnRenamed("ts", "transaction_date").withColumnRenamed("value", "last_close"),
                     keys=("pair_id", "ticker"))
    b = sorted((r.pair_id, r.event_id, r.ema_9, r.ema_50) for r in batch.collect())
    s = sorted((r.user_id, r.event_id, r.ema_9, r.ema_50) for r in two.collect())
    assert b == s


def test_late_event_routed_not_applied(spark):
    ev = _events(spark, n=100, users=2)
    late = spark.createDataFrame([(1000, dt.datetime(2024, 1, 1, 0, 5, 30), 0, 50.0)], ev.schema)
    out = _run(spark, [ev, late])
    lates = out.filter("late").collect()
    assert len(lates) == 1 and lates[0].event_id == 1000 and lates[0].ema_9 is None


def test_stream_upsert_keeps_latest_and_is_idempotent(spark):
    d = dt.date(2024, 1, 2)
    first = raw_rows(spark, [(1, d, "10", T0), (2, d, "20", T0)]).withColumn("frequency", F.lit("daily"))
    second = raw_rows(spark, [(1, d, "11", T0 + dt.timedelta(hours=1))]).withColumn("frequency", F.lit("daily"))
    base = scratch_path(spark, "test-upsert")
    landing, target, ckpt = f"{base}/in", f"{base}/t", f"{base}/ck"
    for b in (first, second):
        b.write.mode("append").parquet(landing)
        run_available_now(stream_bars(spark, landing).writeStream
                          .foreachBatch(upsert_latest(target)).option("checkpointLocation", ckpt))
    got = sorted((r.pair_id, str(r.last_close)) for r in latest_view(spark, target).collect())
    assert got == [(1, "11.0000"), (2, "20.0000")]
    # replaying batch 0 rewrites the same partition: no duplicate rows
    upsert_latest(target)(first, 0)
    assert latest_view(spark, target).count() == 2


def test_compact_folds_batches_into_latest(spark):
    from barlens.streaming.bars import compact
    d = dt.date(2024, 1, 2)
    base = scratch_path(spark, "test-compact")
    target, out = f"{base}/t", f"{base}/c"
    upsert_latest(target)(raw_rows(spark, [(1, d, "10", T0)]).withColumn("frequency", F.lit("daily")), 0)
    upsert_latest(target)(raw_rows(spark, [(1, d, "12", T0)]).withColumn("frequency", F.lit("daily")), 1)
    compact(spark, target, out)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and str(rows[0].last_close) == "12.0000"   # later batch wins the tie


def _run_sma(spark, batches):
    from barlens.streaming.moving import stream_sma
    base = scratch_path(spark, "test-sma")
    landing, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/ck"
    for b in batches:
        b.write.mode("append").parquet(landing)
        run_available_now(stream_sma(spark.readStream.schema(b.schema).parquet(landing))
                          .writeStream.format("parquet").option("path", out)
                          .option("checkpointLocation", ckpt).outputMode("append"), spark=spark, conf=STATE_CONF)
    return spark.read.parquet(out)


def _sma_by_hand(rows, periods):
    """(event id, period) -> (mean, mean of the row before) by definition."""
    out = {}
    for n in periods:
        means = []
        for i in range(len(rows)):
            known = [v for _, v in rows[max(0, i - n + 1):i + 1] if v is not None]
            means.append((sum(round(v * 100) for v in known) / 100) / len(known) if known else None)
        for i, (e, _) in enumerate(rows):
            out[e, n] = means[i], means[i - 1] if i else None
    return out


def test_moving_averages_on_a_stream(spark):
    """Three deliveries, values missing, series shorter and longer than the frames; late rows rebuilt."""
    from barlens.operators.indicators import SMA_PERIODS
    from barlens.streaming.moving import with_rebuilt_sma
    ev = _events(spark, n=900, users=4).withColumn("value", F.when(F.col("event_id") % 13 != 4, F.col("value"))) \
        .filter("user_id <> 3 or event_id < 40")
    late = F.col("user_id") == 2
    parts = [ev.filter((F.col("event_id") < 333) & ~(late & (F.col("event_id") % 10 == 7))),
             ev.filter((F.col("event_id") >= 333) & (F.col("event_id") < 350)),
             ev.filter((F.col("event_id") >= 350) | (F.col("event_id") < 333) & late & (F.col("event_id") % 10 == 7))]
    out = _run_sma(spark, parts)
    flagged = {r.user_id for r in out.filter("late").select("user_id").collect()}
    assert flagged == {2}
    got = {r.event_id: r for r in with_rebuilt_sma(out, ev).collect()}
    rows = ev.orderBy("user_id", "ts", "event_id").collect()
    assert len(got) == len(rows)
    for user in range(4):
        own = [(r.event_id, r.value) for r in rows if r.user_id == user]
        for (e, n), (mean, prev) in _sma_by_hand(own, SMA_PERIODS).items():
            assert (got[e][f"sma_{n}"], got[e][f"prev_sma_{n}"]) == (mean, prev), (user, e, n)
    signals = {r.sma_signal_5_15 for r in got.values()}
    assert signals == {None, "BUY", "SELL"}
    for r in got.values():
        up = r.prev_sma_5 is not None and r.sma_5 is not None and r.sma_5 > r.sma_15 and r.prev_sma_5 < r.prev_sma_15
        assert (r.sma_signal_5_15 == "BUY") == up


class KeptState:
    """A state that answers one question per key and batch: what it holds."""

    def __init__(self, held):
        self.held, self.reads = held, 0

    def exists(self):
        raise AssertionError("asked twice")

    def get(self):
        self.reads += 1
        return self.held

    def update(self, value):
        self.held = value

    put = update


def test_processors_ask_for_each_state_once():
    """Each question is a round trip to the JVM, for every key of every micro-batch."""
    frame = pd.DataFrame({"ts": pd.to_datetime(["2024-01-01", "2024-01-02"]), "event_id": [1, 2], "value": [1.5, 2.5], "value_cents": [150, 250]})
    later = frame.assign(ts=frame["ts"] + pd.Timedelta(days=2))
    ema = IndicatorProcessor("user_id", "ts", "event_id", "value")
    ema.ema, ema.window = KeptState(None), KeptState(None)
    sma = MovingAverageProcessor(["user_id", "ts", "event_id", "value"])
    sma.state = KeptState(None)
    for n, f in enumerate((frame, later), 1):
        out = pd.concat(list(ema.handleInputRows((7,), iter([f]), None)))
        assert out["avg_value_30"].tolist() == [[1.5, 2.0], [5.5 / 3, 2.0]][n - 1] and not out["late"].any()
        out = pd.concat(list(sma.handleInputRows((7,), iter([f]), None)))
        assert out["sma_5"].tolist() == [[1.5, 2.0], [5.5 / 3, 2.0]][n - 1]
        assert ema.ema.reads == sma.state.reads == n and ema.window.reads == n - 1
