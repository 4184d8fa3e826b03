import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from barlens.operators.ema import alpha, apply_delivery, ema_path, ema_resume, ema_state, rebuild_series, with_ema
from barlens.operators.indicators import daily_liquid_bars, liquid, with_prev, with_sma
from barlens.plans import models
from helpers import days

SCHEMA = "pair_id bigint, ticker string, transaction_date date, last_close decimal(10,4), volume bigint"


def series(spark, closes, pair_id=1, ticker="A", start=dt.date(2024, 1, 1), volume=10):
    ds = days(len(closes), start)
    rows = [(pair_id, ticker, d, None if c is None else Decimal(str(c)), volume)
            for d, c in zip(ds, closes)]
    return spark.createDataFrame(rows, SCHEMA)


def test_first_row_seed(spark):
    df = series(spark, [12.5])
    sma = with_prev(with_sma(df, (5, 15)), ["sma_5", "sma_15"]).first()
    ema = with_ema(df).first()
    assert sma.sma_5 == sma.sma_15 == 12.5 and sma.prev_sma_5 is None
    assert ema.ema_9 == ema.ema_21 == ema.ema_50 == 12.5 and ema.prev_ema_9 is None


def test_warm_up_equality_no_signal(spark):
    df = series(spark, [10, 11, 12, 13, 14])
    sma = with_prev(with_sma(df, (5, 15)), ["sma_5", "sma_15"])
    out = models.sma_crossover(sma, pairs=((5, 15),)).orderBy("transaction_date")
    rows = out.collect()
    assert all(r.sma_5 == r.sma_15 for r in rows)
    assert all(r.sma_signal_5_15 is None for r in rows)


def test_sma_running_sum_equals_direct_frame(spark):
    rnd = random.Random(7)
    closes = [round(rnd.uniform(1, 2000), 2) for _ in range(400)]
    df = series(spark, closes)
    got = with_sma(df, (5, 21, 150)).orderBy("transaction_date").collect()
    w = Window.partitionBy("pair_id", "ticker").orderBy("transaction_date")
    direct = df.select(*[(F.sum("last_close").over(w.rowsBetween(-(n - 1), 0)).cast("double")
                          / F.count("last_close").over(w.rowsBetween(-(n - 1), 0))).alias(f"d{n}")
                         for n in (5, 21, 150)], "transaction_date").orderBy("transaction_date").collect()
    for g, d in zip(got, direct):
        assert (g.sma_5, g.sma_21, g.sma_150) == (d.d5, d.d21, d.d150)


def test_ema_matches_python_recurrence_and_stays_in_range(spark):
    rnd = random.Random(3)
    closes = [round(rnd.uniform(50, 60), 2) for _ in range(300)]
    rows = with_ema(series(spark, closes)).orderBy("transaction_date").collect()
    for n in (9, 21, 50):
        expect = ema_path([float(Decimal(str(c))) for c in closes], alpha(n))
        assert [r[f"ema_{n}"] for r in rows] == expect
    lo, hi = float("inf"), float("-inf")
    for r, c in zip(rows, closes):
        lo, hi = min(lo, c), max(hi, c)
        assert lo - 1e-9 <= r.ema_9 <= hi + 1e-9


def test_null_close_mid_series_nulls_rest(spark):
    rows = with_ema(series(spark, [10, 11, None, 12])).orderBy("transaction_date").collect()
    assert rows[1].ema_9 is not None
    assert [r.ema_9 for r in rows[2:]] == [None, None]


def test_ema_resume_equals_full_run_and_flags_late(spark):
    rnd = random.Random(5)
    closes = [round(rnd.uniform(10, 20), 2) for _ in range(120)]
    df = series(spark, closes)
    cut = dt.date(2024, 1, 1) + dt.timedelta(days=59)
    full = with_ema(df).filter(F.col("transaction_date") > F.lit(cut))
    state = ema_state(with_ema(df.filter(F.col("transaction_date") <= F.lit(cut)), prev=False))
    newer = df.filter(F.col("transaction_date") > F.lit(cut))
    late_bar = df.filter(F.col("transaction_date") == F.lit(cut - dt.timedelta(days=3)))
    out = ema_resume(newer.unionByName(late_bar), state)
    resumed = out.filter(~F.col("late")).drop("late")
    cols = ["transaction_date", "ema_9", "ema_21", "ema_50", "prev_ema_9", "prev_ema_21", "prev_ema_50"]
    assert sorted(resumed.select(cols).collect()) == sorted(full.select(cols).collect())
    late = out.filter("late")
    assert late.count() == 1
    rebuilt = rebuild_series(df, late)
    assert rebuilt.count() == len(closes)


def test_liquidity_window_equals_semi_join(spark):
    a = series(spark, [10] * 5, pair_id=1, volume=10)
    b = series(spark, [10] * 5, pair_id=2, ticker="B", volume=1000)
    stock = a.unionByName(b).withColumn("frequency", F.lit("daily"))
    via_window = sorted(r.pair_id for r in daily_liquid_bars(stock, 500).select("pair_id").distinct().collect())
    via_agg = sorted(r.pair_id for r in liquid(stock, 500).collect())
    assert via_window == via_agg == [2]


def test_non_strict_start_fires_on_row_two(spark):
    from barlens.operators.signals import with_crossovers
    ema = with_ema(series(spark, [10, 11]))
    strict = with_crossovers(ema, "ema", ((9, 21),)).orderBy("transaction_date").collect()
    loose = with_crossovers(ema, "ema", ((9, 21),), strict=False).orderBy("transaction_date").collect()
    assert [r.ema_signal_9_21 for r in strict] == [None, None]
    assert [r.ema_signal_9_21 for r in loose] == [None, "BUY"]


def test_apply_delivery_equals_full_recompute(spark):
    from barlens.operators.ema import apply_delivery
    rnd = random.Random(9)
    a = series(spark, [round(rnd.uniform(10, 20), 2) for _ in range(60)], pair_id=1, ticker="A")
    b = series(spark, [round(rnd.uniform(10, 20), 2) for _ in range(60)], pair_id=2, ticker="B")
    before = a.unionByName(b).filter(F.col("transaction_date") <= F.lit(dt.date(2024, 2, 9)))
    history = with_ema(before)
    state = ema_state(history)
    # delivery: new days for both; instrument 1 also corrects an old bar; instrument 3 is new
    corrected = a.filter(F.col("transaction_date") == F.lit(dt.date(2024, 1, 20))).withColumn(
        "last_close", F.lit(Decimal("99.0000")))
    c = series(spark, [5, 6, 7], pair_id=3, ticker="C")
    new_days = a.unionByName(b).filter(F.col("transaction_date") > F.lit(dt.date(2024, 2, 9)))
    delivered = new_days.unionByName(corrected).unionByName(c)
    after = (a.filter(F.col("transaction_date") != F.lit(dt.date(2024, 1, 20))).unionByName(corrected)
             .unionByName(b).unionByName(c))
    got = apply_delivery(history, state, delivered, after)
    want = with_ema(after)
    cols = ["pair_id", "transaction_date", "ema_9", "ema_21", "ema_50", "prev_ema_9"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_ema_resume_after_a_null_close(spark):
    """A NULL close before or after the cut: resuming equals the full run, NULL for good."""
    for closes, cut in (([10, 11, None, 12, 13, 14], 4), ([10, 11, 12, None, 13, 14], 3), ([None, 1, 2, 3, 4, 5], 2)):
        rows = [(1, "T", d, None if c is None else float(c)) for d, c in zip(days(6), closes)]
        bars = spark.createDataFrame(rows, "pair_id bigint, ticker string, transaction_date date, last_close double")
        full = {r.transaction_date: tuple(r)[4:] for r in with_ema(bars).collect()}
        day = days(6)[cut - 1]
        state = ema_state(with_ema(bars.filter(F.col("transaction_date") <= day), prev=False))
        out = ema_resume(bars.filter(F.col("transaction_date") > day), state).drop("late").collect()
        assert len(out) == 6 - cut
        for r in out:
            assert tuple(r)[4:] == full[r.transaction_date]


def test_apply_delivery_lets_series_leave(spark):
    """A series that is no longer among the bars (below the liquidity floor) goes."""
    schema = "pair_id bigint, ticker string, transaction_date date, last_close double"
    old = spark.createDataFrame([(p, "T", d, 1.0 * p + i) for p in (1, 2) for i, d in enumerate(days(4))], schema)
    new = spark.createDataFrame([(1, "T", d, 1.0 + i) for i, d in enumerate(days(6))], schema)
    history = with_ema(old)
    delivered = new.filter(F.col("transaction_date") > days(6)[3])
    got = apply_delivery(history, ema_state(history), delivered, new)
    assert sorted(got.collect()) == sorted(with_ema(new).select(*got.columns).collect())


def test_long_series_needs_one_batch_of_memory(spark):
    """The recurrence yields batch by batch; what it holds between batches are the last EMAs."""
    import pyarrow as pa

    from barlens.operators import ema as E
    n, size = 50_000, 500
    values = [100 + (i * 37 % 11) - 5.0 for i in range(n)]
    taken = []

    def batches():
        for a in range(0, n, size):
            taken.append(a)
            yield pa.RecordBatch.from_pydict({
                E._X: values[a:a + size], E._SEQ: list(range(a + 1, a + size + 1)),
                E._NEW: [a + i == 0 for i in range(size)], E._LATE: [False] * size, "k": [1] * size})

    out, got = E._recur(batches(), (9, 21), ["k", "ema_9", "ema_21", "prev_ema_9"], True), []
    for i, b in enumerate(out):
        assert len(taken) == i + 1          # no batch is read ahead, none is kept
        got += b.column(1).to_pylist()
    assert got == E.ema_path(values, E.alpha(9))
    broken = pa.RecordBatch.from_pydict({E._X: [1.0, 2.0], E._SEQ: [1, 3], E._NEW: [True, False], E._LATE: [False, False]})
    import pytest
    with pytest.raises(ValueError):
        list(E._recur(iter([broken]), (9,), ["ema_9"], True))


def test_ema_over_small_arrow_batches(spark):
    """Series of many batches, and many series in a batch, give the recurrence."""
    from barlens.operators.ema import alpha, ema_path
    rnd = random.Random(3)
    sizes = {1: 700, 2: 1, 3: 40, 4: 333}
    closes = {p: [round(rnd.uniform(10, 20), 2) for _ in range(n)] for p, n in sizes.items()}
    rows = [(p, "T", d, c) for p, cs in closes.items() for d, c in zip(days(len(cs)), cs)]
    bars = spark.createDataFrame(rows, "pair_id bigint, ticker string, transaction_date date, last_close double").repartition(6)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        got = with_ema(bars).orderBy("pair_id", "transaction_date").collect()
    finally:
        spark.conf.set(key, before)
    for p, cs in closes.items():
        assert [r.ema_21 for r in got if r.pair_id == p] == ema_path(cs, alpha(21))
