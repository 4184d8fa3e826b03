"""MDL-3: unify, type and deduplicate raw bars, then attach asset attributes.

Plan shape (one job):

    4 raw scans --union--> type (try_cast) --split--> quarantine
                                              \\--> latest per (pair, freq, day)
                                              --> join assets (strategy by the
                                                  bytes measured at run time)

Where the number of tasks is given, the typed bars are shuffled once, by instrument:
the latest rows, the assets and whatever is keyed by instrument need no further shuffle and
no bar is sorted before the first. A day that was delivered many times then comes whole to
the task of its instrument, whose sort spills and whose top-1 holds one row. Without it the top-1
of each map task comes before the shuffle (partial top-1, shuffle, final top-1), and such a day
is cut down to one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlens.functions import sqlexpr as X
from barlens.functions.sqlexpr import run_sql
from barlens.schemas import RAW_BAR, STOCK_DATA_COLUMNS

PRICE_FIELDS = ("last_open", "last_close", "last_min", "last_max")
BAR_KEY = ("pair_id", "frequency", "transaction_date")


def latest_per(df: DataFrame, keys: list[str], order: list[Column],
               rank_col: str | None = None) -> DataFrame:
    """Keep the first row of each key group under ``order`` (WIN-1/TOP-1).

    ``order`` must be a total order inside a group for a deterministic result.
    Written as ``row_number() = 1`` so Catalyst plans a WindowGroupLimit that
    already drops non-winning rows on the map side.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) == 1)
    return out if rank_col else out.drop(name)


def tag_raw(raw: DataFrame, frequency: str, source_rank: int) -> DataFrame:
    """SET-1 branch: a raw table tagged with its frequency and its source
    rank (current feeds rank above historical ones on equal load times)."""
    return (raw.withColumn("frequency", F.lit(frequency))
            .withColumn("_source_rank", F.lit(source_rank)))


def type_bars(tagged: DataFrame) -> DataFrame:
    """Text -> typed bar columns (SC-3..SC-6), plus ``_ok``: every field that
    has text parsed, and the row has an instrument and a date."""
    def failed(typed: str, text: str) -> str:
        return f"({typed} IS NULL AND TRIM({text}) IS NOT NULL AND TRIM({text}) <> '')"
    checks = " AND ".join(f"NOT {failed(c, t)}" for c, t in _CHECKED)
    prices = ", ".join(f"{X.parse_price(c)} AS {c}" for c in PRICE_FIELDS)
    texts = ", ".join(f"{c} AS _{c}_text" for c in PRICE_FIELDS)
    return run_sql(f"""
        SELECT *, (pair_id IS NOT NULL AND transaction_date IS NOT NULL AND {checks}) AS _ok FROM (
          SELECT pair_id, CAST(row_date_timestamp AS DATE) AS transaction_date, {prices},
                 {X.parse_count('volume_raw')} AS volume, change_percent_raw AS change_percent,
                 frequency, record_created_on, _source_rank, {texts}, volume_raw AS _volume_text
          FROM {{src}})""", src=tagged)


_CHECKED = [*[(c, f"_{c}_text") for c in PRICE_FIELDS], ("volume", "_volume_text")]


def _failed(typed_col: str, text_col: str) -> Column:
    t = F.trim(F.col(text_col))
    return F.col(typed_col).isNull() & t.isNotNull() & (t != "")


def bad_reason(typed: DataFrame) -> Column:
    """Comma-separated names of the fields that made a row bad."""
    reasons = [F.when(F.col("pair_id").isNull(), F.lit("pair_id")),
               F.when(F.col("transaction_date").isNull(), F.lit("row_date_timestamp"))]
    reasons += [F.when(_failed(c, t), F.lit("volume_raw" if c == "volume" else c))
                for c, t in _CHECKED]
    return F.concat_ws(",", *reasons)


def good_rows(typed: DataFrame, strict: bool = False) -> DataFrame:
    """Rows that parsed. ``strict``: a row that didn't fails the job, as the load of a
    typed table does; nothing is left out in silence."""
    ok = F.col("_ok")
    if strict:
        said = F.concat(F.lit("bar that does not parse: pair_id "), F.coalesce(F.col("pair_id").cast("string"), F.lit("NULL")),
                        F.lit(", fields "), bad_reason(typed))
        ok = F.when(ok, True).otherwise(F.raise_error(said).cast("boolean"))
    return typed.filter(ok).drop("_ok", "_volume_text", *[f"_{c}_text" for c in PRICE_FIELDS])


def quarantined_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(~F.col("_ok")).select(
        "pair_id", "frequency", "record_created_on",
        *[F.col(f"_{c}_text").alias(c) for c in PRICE_FIELDS],
        F.col("_volume_text").alias("volume_raw"), bad_reason(typed).alias("reason"))


def typed_feeds(historical_daily: DataFrame, historical_weekly: DataFrame,
                current_daily: DataFrame, current_weekly: DataFrame,
                strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """SET-1 + SC-3..SC-6: (typed good rows, quarantined raw rows with a reason).
    ``strict``: see ``good_rows``."""
    raw = [f.name for f in RAW_BAR.fields]
    branches = [("hd", "daily", 0), ("hw", "weekly", 0), ("cd", "daily", 1), ("cw", "weekly", 1)]
    union = " UNION ALL ".join(
        f"SELECT {', '.join(raw)}, '{freq}' AS frequency, {rank} AS _source_rank FROM {{{name}}}"
        for name, freq, rank in branches)
    tagged = run_sql(union, hd=historical_daily, hw=historical_weekly,
                     cd=current_daily, cw=current_weekly)
    typed = type_bars(tagged)
    return good_rows(typed, strict), quarantined_rows(typed)


def _order_sql(order: list[str]) -> str:
    return ", ".join(order)


_DEDUP_ORDER = ["record_created_on DESC NULLS LAST", "_source_rank DESC",
                *[f"{c} DESC NULLS LAST" for c in (*PRICE_FIELDS, "volume", "change_percent")]]


def dedup_bars(good: DataFrame, dealt: tuple[str, ...] = ()) -> DataFrame:
    """WIN-1: one row per (pair_id, frequency, transaction_date). The latest
    load wins; on equal load times the current feed wins; remaining ties
    fall to the full row so the choice is deterministic.

    ``row_number() = 1``: Catalyst plans a WindowGroupLimit that keeps only
    each key's winner on the map side, before the shuffle. ``dealt``: columns that follow from the
    key and by which the rows were dealt; they are shuffled no more and leave sorted by them."""
    cols = [c for c in good.columns if c != "_source_rank"]
    return run_sql(
        f"SELECT {', '.join(cols)} FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {', '.join((*dealt, *BAR_KEY))} "
        f"ORDER BY {_order_sql(_DEDUP_ORDER)}) AS _rn FROM {{src}}) WHERE _rn = 1", src=good)


def unify_bars(historical_daily: DataFrame, historical_weekly: DataFrame,
               current_daily: DataFrame, current_weekly: DataFrame,
               assets: DataFrame, strict: bool = False, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """MDL-3. Return (stock_data, quarantine).

    ``tasks``: deal the typed bars by instrument into so many partitions; what is keyed by
    instrument, from the dedup on, then needs no further shuffle, and none that adaptive execution
    merges by compressed bytes, which say little about wide rows.

    stock_data has one row per (pair_id, frequency, transaction_date) (see
    ``dedup_bars``). Bars without an asset row are dropped (inner join, JN-1).
    quarantine holds raw rows whose text did not parse, with a reason.
    """
    good, quarantine = typed_feeds(historical_daily, historical_weekly,
                                   current_daily, current_weekly, strict)
    latest = dedup_bars(good.repartition(tasks, "pair_id") if tasks else good)
    return asset_joined(latest, assets), quarantine


def asset_joined(latest: DataFrame, assets: DataFrame) -> DataFrame:
    """JN-1, PRJ-5, SC-6, SC-8: deduplicated bars with the attributes of their instrument."""
    ua = unique_assets(assets)
    out = run_sql(f"""
        SELECT b.pair_id, date_format(b.transaction_date, 'yyyyMMdd') AS transaction_id,
               b.transaction_date, b.last_open, b.last_close, b.last_min, b.last_max, b.volume,
               b.change_percent, b.frequency, a.uid, a.primary_uid, a.ticker, a.stock_name,
               a.sector, a.primary_sector, a.secondary_sector, a.market_cap,
               {X.cap_bucket('a.market_cap')} AS market_cap_category,
               CAST(date_trunc('quarter', b.transaction_date) AS DATE) AS quarter_start,
               b.record_created_on, 1 AS row_num
        FROM {{bars}} b JOIN {{assets}} a ON b.pair_id = a.pair_id""", bars=latest, assets=ua)
    return out.select(*STOCK_DATA_COLUMNS)


def unique_assets(assets: DataFrame) -> DataFrame:
    """One asset row per pair_id (latest load, then uid), so a duplicated
    master row cannot fan bars out."""
    return run_sql("""
        SELECT pair_id, uid, primary_uid, ticker, stock_name, sector, primary_sector,
               secondary_sector, market_cap FROM (
          SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY record_created_on DESC NULLS LAST,
                                       uid ASC NULLS LAST, ticker ASC NULLS LAST) AS _rn
          FROM {src} WHERE pair_id IS NOT NULL) WHERE _rn = 1""", src=assets)


def bars_between(df: DataFrame, lo, hi, col: str | Column = "transaction_date") -> DataFrame:
    """SRC-7: closed date range; pushed into the Parquet scan when ``df`` is a scan."""
    return df.filter((F.col(col) if isinstance(col, str) else col).between(F.lit(lo), F.lit(hi)))


def frequency_counts(stock_data: DataFrame) -> DataFrame:
    """Bars and instruments per frequency (SRC-8 / FLT-1)."""
    return (stock_data.groupBy("frequency")
            .agg(F.count(F.lit(1)).alias("n_bars"),
                 F.countDistinct("pair_id").alias("n_instruments"),
                 F.min("transaction_date").alias("first_date"),
                 F.max("transaction_date").alias("last_date")))
