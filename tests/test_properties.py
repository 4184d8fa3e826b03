"""Property tests: the O(1)-per-row rewrites equal the direct definitions."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from barlens.operators.indicators import with_sma
from barlens.operators.trades import pair_trades

closes = st.lists(st.one_of(st.none(), st.decimals(min_value=Decimal("0.01"), max_value=Decimal("99999"),
                                                   places=2, allow_nan=False, allow_infinity=False)),
                  min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=closes, n=st.integers(min_value=1, max_value=20))
def test_running_sum_mean_equals_frame_mean(spark, xs, n):
    d0 = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(1, "T", d0 + dt.timedelta(days=i), x) for i, x in enumerate(xs)],
                               "pair_id bigint, ticker string, transaction_date date, last_close decimal(10,4)")
    w = Window.partitionBy("pair_id", "ticker").orderBy("transaction_date")
    frame = w.rowsBetween(-(n - 1), 0)
    direct = F.try_divide(F.sum("last_close").over(frame).cast("double"), F.count("last_close").over(frame))
    got = with_sma(df, (n,), prev=True).orderBy("transaction_date").collect()
    want = df.select("pair_id", "ticker", "transaction_date", direct.alias("m")).withColumn(
        "p", F.lag("m").over(w)).orderBy("transaction_date").collect()
    assert [(r[f"sma_{n}"], r[f"prev_sma_{n}"]) for r in got] == [(r.m, r.p) for r in want]


signals = st.lists(st.sampled_from([None, None, "BUY", "SELL"]), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(s1=signals, s2=signals)
def test_collapsed_pairing_equals_earliest_sell_over_strategies(spark, s1, s2):
    n = min(len(s1), len(s2))
    d0 = dt.date(2024, 1, 1)
    rows = [(1, "T", "N", "U", "R", "S", None, "Unknown", d0 + dt.timedelta(days=i), 1,
             Decimal(10 + i), s1[i], s2[i]) for i in range(n)]
    df = spark.createDataFrame(rows, "pair_id bigint, ticker string, stock_name string, primary_uid string, "
                                     "primary_sector string, secondary_sector string, market_cap decimal(24,4), "
                                     "market_cap_category string, transaction_date date, volume bigint, "
                                     "last_close decimal(10,4), s1 string, s2 string")
    got = {(r.buy_date, r.strategy, r.sell_date) for r in pair_trades(df, ["s1", "s2"]).collect()}
    want = set()
    for i in range(n):
        best = None
        for name, sig in (("s1", s1), ("s2", s2)):
            if sig[i] != "BUY":
                continue
            sell = next((j for j in range(i + 1, n) if sig[j] == "SELL"), None)
            if sell is not None and (best is None or (sell, name) < best):
                best = (sell, name)
        if best is not None:
            want.add((d0 + dt.timedelta(days=i), best[1], d0 + dt.timedelta(days=best[0])))
    assert got == want
