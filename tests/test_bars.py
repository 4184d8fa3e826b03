import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from barlens.operators.bars import unify_bars
from barlens.operators.universe import pending, universe
from helpers import T0, assets, days, empty_raw, raw_rows


def _unify(spark, hist, cur, asset_rows):
    e = empty_raw(spark)
    return unify_bars(hist, e, cur, e, assets(spark, asset_rows))


def test_duplicate_bar_latest_load_wins(spark):
    d = dt.date(2024, 1, 2)
    hist = raw_rows(spark, [(1, d, "10.00", T0)])
    cur = raw_rows(spark, [(1, d, "1,010.50", T0 + dt.timedelta(hours=1))])
    clean, quarantine = _unify(spark, hist, cur, [(1, "A", None)])
    rows = clean.collect()
    assert len(rows) == 1 and rows[0].last_close == Decimal("1010.5000")
    assert rows[0].transaction_id == "20240102" and rows[0].market_cap_category == "Unknown"
    assert rows[0].quarter_start == dt.date(2024, 1, 1)
    assert quarantine.count() == 0


def test_equal_load_time_current_feed_wins(spark):
    d = dt.date(2024, 1, 2)
    clean, _ = _unify(spark, raw_rows(spark, [(1, d, "10.00", T0)]),
                      raw_rows(spark, [(1, d, "11.00", T0)]), [(1, "A", None)])
    assert clean.first().last_close == Decimal("11.0000")


def test_bad_text_is_quarantined_not_dropped_silently(spark):
    ds = days(3)
    hist = raw_rows(spark, [(1, ds[0], "NaN", T0), (1, ds[1], "-", T0), (1, ds[2], "12.5", T0, "12", "12.0")])
    clean, quarantine = _unify(spark, hist, empty_raw(spark), [(1, "A", None)])
    assert clean.count() == 1
    assert clean.first().volume == 12
    reasons = sorted(r.reason for r in quarantine.collect())
    assert reasons == ["last_open,last_close,last_min,last_max"] * 2
    assert quarantine.count() == 2


def test_bars_without_asset_dropped_and_duplicate_assets_do_not_fan_out(spark):
    d = dt.date(2024, 1, 2)
    hist = raw_rows(spark, [(1, d, "10", T0), (2, d, "20", T0)])
    clean, _ = _unify(spark, hist, empty_raw(spark),
                      [(1, "A", Decimal("1e12"), T0), (1, "A2", Decimal("1e12"), T0 + dt.timedelta(1))])
    rows = clean.collect()
    assert len(rows) == 1 and rows[0].ticker == "A2" and rows[0].market_cap_category == "Mid Cap"


def test_universe_or_match_and_distinct(spark):
    a = assets(spark, [(1, "X", None), (2, "Y", None), (3, "Z", None)])
    a = a.withColumn("uid", F.when(F.col("pair_id") == 2, F.lit("BOM:123")).otherwise(F.col("uid")))
    screen = spark.createDataFrame(
        [("True", " x "), ("True", "y"), ("False", "z"), ("True", "X")], "halal_ind string, nse_code string")
    got = sorted(r.pair_id for r in universe(screen, a).collect())
    assert got == [1, 2]


def test_not_in_with_null_is_empty(spark):
    u = spark.createDataFrame([(1,), (2,), (3,)], "pair_id bigint")
    loaded = spark.createDataFrame([(1,), (None,)], "pair_id bigint")
    assert pending(u, loaded).count() == 0
    assert sorted(r.pair_id for r in pending(u, loaded, null_aware=False).collect()) == [2, 3]
    loaded2 = spark.createDataFrame([(1,)], "pair_id bigint")
    assert sorted(r.pair_id for r in pending(u, loaded2).collect()) == [2, 3]
    assert pending(u, spark.createDataFrame([], "pair_id bigint")).count() == 3


def test_api_helpers(spark):
    from pyspark.sql import functions as F
    from barlens.operators.bars import latest_per
    from barlens.operators.indicators import with_seq
    from barlens.sinks import as_view
    from barlens.sources.readers import valid_date, window_before
    df = spark.createDataFrame([(1, "2024-01-02", 5), (1, "2024-01-01", 7), (2, "bad", 1)],
                               "k bigint, d string, v int")
    top = latest_per(df, ["k"], [F.col("v").desc()]).collect()
    assert sorted((r.k, r.v) for r in top) == [(1, 7), (2, 1)]
    typed = df.withColumn("d", valid_date("d"))
    assert typed.filter("k = 2").first().d is None
    seq = with_seq(typed.filter("d IS NOT NULL").withColumnRenamed("k", "pair_id")
                   .withColumn("ticker", F.lit("t")).withColumnRenamed("d", "transaction_date"))
    assert sorted((r.transaction_date.day, r.seq_num) for r in seq.collect()) == [(1, 1), (2, 2)]
    assert window_before(dt.date(2024, 1, 20)) == (dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    as_view(df, "api_helpers_view")
    assert spark.table("api_helpers_view").count() == 3


def test_dedup_is_idempotent(spark):
    from barlens.operators.bars import dedup_bars, typed_feeds
    d = dt.date(2024, 1, 2)
    hist = raw_rows(spark, [(1, d, "10", T0), (1, d, "12", T0), (2, d, "20", T0)])
    cur = raw_rows(spark, [(1, d, "11", T0 + dt.timedelta(hours=1))])
    good, _ = typed_feeds(hist, empty_raw(spark), cur, empty_raw(spark))
    once = dedup_bars(good)
    twice = dedup_bars(once.withColumn("_source_rank", F.lit(0)))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == 2


def test_strict_models_fail_on_bad_rows(spark):
    """The batch models never shorten a series in silence: a bad bar fails the job; the
    form with a quarantine returns every row on one side or the other."""
    import pytest

    from barlens.plans.models import stock_data, stock_data_and_quarantine
    d = dt.date(2024, 1, 2)
    feeds = {"historical_daily": raw_rows(spark, [(1, d, "10", T0), (1, d + dt.timedelta(days=1), "1,000,000.00", T0)]),
             "historical_weekly": empty_raw(spark), "current_daily": empty_raw(spark), "current_weekly": empty_raw(spark),
             "assets": assets(spark, [(1, "AAA", None)])}
    with pytest.raises(Exception, match="does not parse: pair_id 1"):
        stock_data(feeds).collect()
    clean, bad = stock_data_and_quarantine(feeds)
    assert clean.count() == 1 and bad.count() == 1
