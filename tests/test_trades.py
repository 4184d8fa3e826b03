import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from barlens.operators.trades import pair_trades

SIG_SCHEMA = ("pair_id bigint, ticker string, stock_name string, primary_uid string, "
              "primary_sector string, secondary_sector string, market_cap decimal(24,4), "
              "market_cap_category string, transaction_date date, volume bigint, "
              "last_close decimal(10,4), s1 string, s2 string")


def frame(spark, rows):
    """rows: (pair_id, day_offset, close, s1, s2)"""
    d0 = dt.date(2024, 1, 1)
    out = [(p, f"T{p}", "N", "U", "R", "S", None, "Unknown", d0 + dt.timedelta(days=o), 1,
            Decimal(str(c)), a, b) for p, o, c, a, b in rows]
    return spark.createDataFrame(out, SIG_SCHEMA)


def test_two_strategies_same_buy_day_collapse(spark):
    df = frame(spark, [(1, 0, 10, "BUY", "BUY"), (1, 3, 12, None, "SELL"), (1, 5, 13, "SELL", None)])
    both = pair_trades(df, ["s1", "s2"], collapse=False).collect()
    assert sorted((r.strategy, r.sell_date.day) for r in both) == [("s1", 6), ("s2", 4)]
    one = pair_trades(df, ["s1", "s2"], collapse=True, keep_rank=True).collect()
    assert len(one) == 1 and one[0].strategy == "s2" and one[0].rn == 1


def test_tie_on_sell_date_goes_to_smaller_strategy_name(spark):
    df = frame(spark, [(1, 0, 10, "BUY", "BUY"), (1, 2, 11, "SELL", "SELL")])
    one = pair_trades(df, ["s2", "s1"], collapse=True).collect()
    assert [r.strategy for r in one] == ["s1"]


def test_open_trade_dropped_by_default(spark):
    df = frame(spark, [(1, 0, 10, "BUY", None), (1, 1, 11, "BUY", None)])
    assert pair_trades(df, ["s1"]).count() == 0
    opened = pair_trades(df, ["s1"], include_open=True).collect()
    assert {r.status for r in opened} == {"OPEN"} and len(opened) == 2


def test_window_pairing_equals_theta_join(spark):
    rnd = random.Random(11)
    rows = []
    for p in (1, 2, 3):
        for o in range(120):
            rows.append((p, o, round(rnd.uniform(5, 50), 2), rnd.choice([None, None, "BUY", "SELL"]),
                         rnd.choice([None, None, None, "BUY", "SELL"])))
    df = frame(spark, rows)
    got = pair_trades(df, ["s1", "s2"], collapse=False)
    sig = df.select("pair_id", "transaction_date", "last_close",
                    F.explode(F.array(F.struct(F.lit("s1").alias("st"), F.col("s1").alias("sg")),
                                      F.struct(F.lit("s2").alias("st"), F.col("s2").alias("sg")))).alias("e")
                    ).select("pair_id", "transaction_date", "last_close", "e.*")
    b, s = sig.filter("sg = 'BUY'").alias("b"), sig.filter("sg = 'SELL'").alias("s")
    theta = (b.join(s, (F.col("b.pair_id") == F.col("s.pair_id")) & (F.col("b.st") == F.col("s.st"))
                    & (F.col("s.transaction_date") > F.col("b.transaction_date")))
             .groupBy("b.pair_id", "b.st", F.col("b.transaction_date").alias("bd"))
             .agg(F.min("s.transaction_date").alias("sd")))
    assert sorted((r.pair_id, r.strategy, r.buy_date, r.sell_date) for r in got.collect()) == \
        sorted((r.pair_id, r.st, r.bd, r.sd) for r in theta.collect())
    assert all(r.sell_date > r.buy_date for r in got.collect())
