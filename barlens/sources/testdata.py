"""Adapters that turn the driver's generated tables into this engine's inputs.

The generated tables are TPC-H-like, so each input of the bar pipeline is
derived from one of them with ordinary Spark jobs:

* bars      - one daily bar per (supplier, ship date) from ``lineitem``
* assets    - the asset master from ``supplier`` x ``nation`` x ``region``
* screen    - the compliance screen from ``supplier``
* raw feeds - the four text bar tables (historical/current x daily/weekly)
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterator, Mapping
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.functions import wall_clock

from barlens.schemas import RAW_BAR
from barlens.session import STORED, at_once, scratch_path, tasks_for

# Fixed values of the generated feeds.
HISTORICAL_BEFORE = dt.date(2001, 7, 1)   # historical feeds hold bars before this day
CURRENT_FROM = dt.date(2001, 6, 1)        # current feeds hold bars from this day on
HISTORICAL_LOADED_AT = dt.datetime(2001, 7, 1, 6, 0, 0)
CURRENT_LOADED_AT = dt.datetime(2001, 11, 5, 12, 30, 0)
ASSETS_LOADED_AT = dt.datetime(2001, 1, 1, 0, 0, 0)
#: The four raw feeds and their load times.
FEEDS = {"historical_daily": HISTORICAL_LOADED_AT, "historical_weekly": HISTORICAL_LOADED_AT,
         "current_daily": CURRENT_LOADED_AT, "current_weekly": CURRENT_LOADED_AT}
CURRENT_CLOSE_BUMP = Decimal("0.01")      # current rows re-state the close
LINES_BYTES = 8 << 20                     # stored bytes of lineitem that one task makes bars of
MARKET_CAP_FACTOR = 300000000             # s_acctbal -> market cap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Daily OHLCV bars: instrument = supplier, day = ship date.

    Open/close are the prices of the first/last line in the total order
    (orderkey, linenumber, partkey, quantity, price).

    The narrow lines are dealt once by instrument and year, in tasks of one size: hardly two lines make a bar, so
    combining before the shuffle would sort every line twice, and the bars lie in order for what reads them.
    """
    day = F.col("l_shipdate").cast("date")
    lines = lineitem.select(F.col("l_suppkey").alias("pair_id"), day.alias("transaction_date"), F.year(day).alias("_year"),
                            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    p = F.col("l_extendedprice").cast("decimal(10,2)")
    k = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return (lines.repartition(tasks_for(lineitem, task_bytes=LINES_BYTES), "pair_id", "_year")
            .groupBy("pair_id", "_year", "transaction_date")
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("volume"),
                 F.min(p).alias("last_min"),
                 F.max(p).alias("last_max"),
                 F.min_by(p, k).alias("last_open"),
                 F.max_by(p, k).alias("last_close")).drop("_year"))


def weekly_from_daily(bars: DataFrame) -> DataFrame:
    """Weekly OHLCV bars dated at the Monday that starts the week."""
    return (bars
            .groupBy("pair_id",
                     F.date_trunc("week", "transaction_date").cast("date").alias("transaction_date"))
            .agg(F.sum("volume").alias("volume"),
                 F.min("last_min").alias("last_min"),
                 F.max("last_max").alias("last_max"),
                 F.min_by("last_open", "transaction_date").alias("last_open"),
                 F.max_by("last_close", "transaction_date").alias("last_close")))


def assets_from_supplier(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Asset master in the ``assets_info`` shape.

    Listing ids vary so that both sides of the universe's OR match and the
    no-colon case are exercised: even suppliers list on NSEI under their
    name; suppliers with key % 7 = 1 carry a bare id without a colon; the
    rest carry a numeric BOM id. The primary id is always the NSEI name.
    """
    name_u = F.upper("s_name")
    k = F.col("s_suppkey")
    uid = (F.when(k % 2 == 0, F.concat(F.lit("NSEI:"), name_u))
           .when(k % 7 == 1, name_u)
           .otherwise(F.concat(F.lit("BOM:"), (k + 500000).cast("string"))))
    cap = F.when(F.col("s_acctbal") >= 0,
                 (F.col("s_acctbal").cast("decimal(12,2)") * F.lit(MARKET_CAP_FACTOR))
                 .cast("decimal(24,4)"))
    # nation (25 rows) and region (5 rows) are fixed-size dimension tables.
    return (supplier
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(uid.alias("uid"),
                    k.alias("pair_id"),
                    F.col("s_name").alias("ticker"),
                    F.col("s_name").alias("stock_name"),
                    F.concat(F.lit("NSEI:"), name_u).alias("primary_uid"),
                    F.concat(F.lit("/equities/"), F.lower("s_name")).alias("path"),
                    F.col("n_name").alias("sector"),
                    cap.alias("market_cap"),
                    F.col("r_name").alias("primary_sector"),
                    F.col("n_name").alias("secondary_sector"),
                    wall_clock(ASSETS_LOADED_AT).alias("record_created_on")))


def screen_from_supplier(supplier: DataFrame) -> DataFrame:
    """Compliance screen: padded lower-case codes, two of three compliant."""
    k = F.col("s_suppkey")
    return supplier.select(
        F.when(k % 3 != 0, "True").otherwise("False").alias("halal_ind"),
        F.col("s_name").alias("stock_name"),
        (k + 500000).cast("string").alias("bse_code"),
        F.concat(F.lit("  "), F.lower("s_name"), F.lit(" ")).alias("nse_code"),
        F.lit("Manufacturing").alias("industry"),
        wall_clock(ASSETS_LOADED_AT).alias("record_created_on"))


MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _grouped(value: str, text: str, tail: int, decimals: int) -> F.Column:
    """``format_number(value, decimals)`` of an exact number of which ``text`` is the plain form. Below a million
    that is the text with at most one comma, before its last ``tail`` characters, and needs no formatter."""
    v, t = F.col(value), F.col(text)
    cut = F.length(t) - tail
    return (F.when(v.between(0, 999) if decimals == 0 else (v >= 0) & (v < 1000), t)
            .when((v >= 1000) & (v < 1000000), F.concat(F.substring(t, F.lit(1), cut), F.lit(","), F.substring(t, cut + 1, F.lit(tail))))
            .otherwise(F.format_number(value, decimals)))


def _day_text(day: str) -> F.Column:
    """``date_format(day, 'MMM dd, yyyy')``, put together from the day's fields where the year has four digits."""
    d = F.col(day)
    two = F.lpad(F.dayofmonth(d).cast("string"), 2, "0")
    named = F.concat(F.elt(F.month(d), *[F.lit(m) for m in MONTHS]), F.lit(" "), two, F.lit(", "), F.year(d).cast("string"))
    return F.when(F.year(d).between(1000, 9999), named).otherwise(F.date_format(d, "MMM dd, yyyy"))


def render_raw(bars: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Typed bars -> the 18-column text layout of the raw bar tables."""
    d = F.col("transaction_date")
    prices = ("last_close", "last_open", "last_max", "last_min")
    pct = F.round(F.try_divide(F.col("last_close") - F.col("last_open"), F.col("last_open")) * 100, 2)
    # the plain texts first: the grouped ones are made from them
    plain = bars.select("pair_id", "transaction_date", "volume", *prices, pct.cast("string").alias("_pct"),
                        F.col("volume").cast("string").alias("_volume"), *[F.col(c).cast("string").alias(f"_{c}") for c in prices])
    cols = {
        "pair_id": F.col("pair_id"),
        "direction_color": F.when(F.col("last_close") >= F.col("last_open"), "greenFont")
                            .otherwise("redFont"),
        "row_date": _day_text("transaction_date"),
        "row_date_raw": F.unix_timestamp(d.cast("timestamp")).cast("string"),
        "row_date_timestamp": d.cast("timestamp_ntz"),
        "volume": _grouped("volume", "_volume", 3, 0),
        # a float round-trip of an integer column: "1234.0"
        "volume_raw": F.col("volume").cast("decimal(20,1)").cast("string"),
        "change_percent": F.concat("_pct", F.lit("%")),
        "change_percent_raw": F.col("_pct"),
        "record_created_on": wall_clock(loaded_at),
        **{c: _grouped(c, f"_{c}", 6, 2) for c in prices},
        **{f"{c}_raw": F.col(f"_{c}") for c in prices},
    }
    return plain.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in RAW_BAR.fields])


def raw_feeds(bars: DataFrame, weekly: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four raw bar tables. June 2001 is in both the historical and the
    current feeds; the current copy has a bumped close and a later load time,
    so deduplication must keep it."""
    weekly = weekly_from_daily(bars) if weekly is None else weekly

    def split(b: DataFrame):
        hist = b.filter(F.col("transaction_date") < F.lit(HISTORICAL_BEFORE))
        cur = (b.filter(F.col("transaction_date") >= F.lit(CURRENT_FROM))
               .withColumn("last_close", (F.col("last_close") + F.lit(CURRENT_CLOSE_BUMP))
                           .cast("decimal(10,2)")))
        return render_raw(hist, HISTORICAL_LOADED_AT), render_raw(cur, CURRENT_LOADED_AT)

    hd, cd = split(bars)
    hw, cw = split(weekly)
    return {"historical_daily": hd, "historical_weekly": hw,
            "current_daily": cd, "current_weekly": cw}


def partly_loaded(historical: DataFrame) -> DataFrame:
    """A historical table whose load has not come to every instrument yet."""
    return historical.filter(F.col("pair_id") % 9 != 4)


def spoilt_feeds(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The feeds with bars that don't parse: a close with letters, an open beyond the
    price type together with a count of words, a missing date."""
    at = lambda rest, day: (F.col("pair_id") % 6 == rest) & (F.dayofmonth("row_date_timestamp") == day)
    return {n: df.withColumns({
        "last_close": F.when(at(1, 3), "12.3o").otherwise(F.col("last_close")),
        "last_open": F.when(at(2, 4), "1,000,000.00").otherwise(F.col("last_open")),
        "volume_raw": F.when(at(2, 4), "many").otherwise(F.col("volume_raw")),
        "row_date_timestamp": F.when(~at(3, 5), F.col("row_date_timestamp")),
    }) if n in FEEDS else df for n, df in feeds.items()}


def dated_as_text(raw: DataFrame) -> DataFrame:
    """(pair_id, date_text) of raw bars; the ninth of a month of some instruments is no date."""
    day = F.col("row_date_timestamp").cast("date")
    bad = (F.col("pair_id") % 4 == 1) & (F.dayofmonth(day) == 9)
    return raw.select("pair_id", F.when(bad, F.date_format(day, "yyyy-MM-'3x'")).otherwise(day.cast("string")).alias("date_text"))


def live_events(events: DataFrame) -> DataFrame:
    """(user_id, ts, event_id, value) with some values missing."""
    gap = (F.col("user_id") % 4 == 1) & (F.col("event_id") % 11 == 5)
    return events.select("user_id", "ts", "event_id", F.when(~gap, F.col("value")).alias("value"))


def inputs(spark: SparkSession, sf_dir: str, bars: DataFrame | None = None,
           weekly: DataFrame | None = None) -> dict[str, DataFrame]:
    """Everything the bar pipeline reads, derived from one scale directory
    (as plans; nothing is written)."""
    if bars is None:
        bars = bars_from_lineitem(table(spark, sf_dir, "lineitem"))
    return raw_feeds(bars, weekly) | _master(spark, sf_dir)


def _master(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The asset master and the compliance screen."""
    t = partial(table, spark, sf_dir)
    return {"assets": assets_from_supplier(t("supplier"), t("nation"), t("region")),
            "screen": screen_from_supplier(t("supplier"))}


# Landed inputs per (application, session, scale directory).
_LANDED: dict[tuple[str, int, str], Landing] = {}


class Landing(Mapping):
    """The pipeline's raw tables by name, each landed as Parquet when it is first asked for: a model
    that reads the assets alone aggregates no bars."""

    NAMES = (*FEEDS, "assets", "screen")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.base = spark, sf_dir, scratch_path(spark, "landing")
        self.stored: dict[str, DataFrame] = {}

    def _land(self, name: str, df: DataFrame) -> DataFrame:
        df.write.options(**STORED).parquet(f"{self.base}/{name}")
        self.stored[name] = self.spark.read.parquet(f"{self.base}/{name}")
        return self.stored[name]

    def _drop(self, *names: str) -> None:
        """Remove tables from which nothing is left to make."""
        for name in names:
            if self.stored.pop(name, None) is not None:
                path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _bars(self, frequency: str) -> DataFrame:
        """The daily or weekly bars from which two feeds are cut, each aggregated once; they go with the last feed."""
        name = "weekly" if frequency == "weekly" else "bars"
        if name in self.stored:
            return self.stored[name]
        return self._land(name, weekly_from_daily(self._bars("daily")) if name == "weekly"
                          else bars_from_lineitem(table(self.spark, self.sf_dir, "lineitem")))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name in self.stored:
            return self.stored[name]
        if name in FEEDS:
            bars = self._bars(name.split("_")[1])
            # both frequencies are rendered alike: the other one is not read
            landed = self._land(name, raw_feeds(bars, bars)[name])
            if all(feed in self.stored for feed in FEEDS):
                self._drop("bars", "weekly")
            return landed
        for part, df in _master(self.spark, self.sf_dir).items():      # both are small and made of suppliers
            self._land(part, df)
        return self.stored[name]

    def bar_feeds(self) -> dict[str, DataFrame]:
        """The four raw bar tables, for whoever reads them all: what is not landed yet is landed side by side,
        the weekly bars and their feeds beside the daily feeds."""
        if any(name not in self.stored for name in FEEDS):
            self._bars("daily")
            at_once(lambda: self["historical_daily"], lambda: self["current_daily"],
                    lambda: (self["historical_weekly"], self["current_weekly"]))
        return {name: self[name] for name in FEEDS}

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)


def landed_inputs(spark: SparkSession, sf_dir: str) -> Landing:
    """The pipeline's raw tables, landed once per application.

    The reference's models read stored raw tables; here the loaders' output
    is written once as Parquet under the shared checkpoint folder (first the
    daily and the weekly bars, from which the four feeds are cut, so each is
    aggregated once) and every query reads those tables.
    """
    key = (spark.sparkContext.applicationId, id(spark), os.path.abspath(sf_dir))
    if key not in _LANDED:
        _LANDED[key] = Landing(spark, sf_dir)
    return _LANDED[key]


# --- document inputs ----------------------------------------------------------

ASSETS_PER_DOCUMENT = 50     # one asset document (API page) per 50 suppliers
SCREEN_ROWS_PER_PAGE = 100   # one screen page per 100 parts
DOCUMENTS_LOADED_AT = dt.datetime(2001, 11, 5, 18, 0, 0)


def asset_documents(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Asset master as JSON documents shaped like the source API's pages
    (column ``value``, one document per line).

    Positional ``data``: [0] exchange, [1] region (primary sector),
    [2] nation (secondary sector), [3] market cap with a numeric ``raw``.
    Suppliers with key % 5 = 0 have no element 3; with key % 11 = 0 or a
    negative balance element 3 is hidden (no ``raw``).
    """
    k = F.col("s_suppkey")
    name_u = F.upper("s_name")

    def datum(value, raw, hidden=F.lit(False)):
        return F.struct(hidden.alias("hidden"), value.alias("value"), raw.alias("raw"),
                        F.lit(0).cast("bigint").alias("sentiment"))

    cap = (F.col("s_acctbal").cast("decimal(12,2)") * F.lit(MARKET_CAP_FACTOR)).cast("decimal(24,2)")
    hidden_cap = (k % 11 == 0) | (F.col("s_acctbal") < 0)
    cap_datum = F.when(hidden_cap, F.struct(F.lit(True).alias("hidden"),
                                            F.lit(None).cast("string").alias("value"),
                                            F.lit(None).cast("string").alias("raw"),
                                            F.lit(None).cast("bigint").alias("sentiment"))) \
        .otherwise(datum(F.format_number(cap, 0), cap.cast("string")))
    base = [datum(F.lit("NSE"), F.lit("NSE")), datum(F.col("r_name"), F.col("r_name")),
            datum(F.col("n_name"), F.col("n_name"))]
    data = F.when(k % 5 == 0, F.array(*base)).otherwise(F.array(*base, cap_datum))
    asset = F.struct(F.lit(False).alias("hidden"),
                     F.concat(F.lit("NSEI:"), name_u).alias("uid"),
                     k.alias("pairID"), F.col("s_name").alias("ticker"),
                     F.col("s_name").alias("name"),
                     F.concat(F.lit("NSEI:"), name_u).alias("primary"),
                     F.concat(F.lit("/equities/"), F.lower("s_name")).alias("path"),
                     F.lit("").alias("logo"), F.lit("").alias("logoDark"),
                     F.col("n_name").alias("sector"))
    rows = (supplier
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.floor(k / ASSETS_PER_DOCUMENT).alias("page"), k,
                    F.struct(asset.alias("asset"), data.alias("data")).alias("row")))
    docs = (rows.groupBy("page")
            .agg(F.sort_array(F.collect_list(F.struct(k.alias("k"), F.col("row")))).alias("rs"))
            .select(F.to_json(F.struct(F.col("rs.row").alias("rows"))).alias("value")))
    # market caps are JSON numbers in the source
    return docs.select(F.regexp_replace("value", r'"raw":"(-?[0-9]+(\.[0-9]+)?)"', '"raw":$1')
                       .alias("value"))


def _escape(c) -> F.Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&#x26;")),
                               F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def screen_pages(part: DataFrame) -> DataFrame:
    """Compliance screen as HTML pages (``page_id``, ``html``), one table of
    up to 100 parts per page; parts with p_size % 3 != 0 carry the 'yes'
    image."""
    k = F.col("p_partkey")
    img = F.concat(F.lit('<img\n   src="https://img.example/'),
                   F.when(F.col("p_size") % 3 != 0, "yes").otherwise("no"),
                   F.lit('.jpg" alt="">'))

    def td(i, body):
        # cells stand on lines of their own, between no-break spaces
        return F.concat(F.lit(f'<td data-cell="{i}">\n  &nbsp;'), body, F.lit("&#160;\t\n</td >"))

    tr = F.concat(F.lit("\n<tr>"),
                  td(1, img), td(2, _escape(F.col("p_name"))),
                  td(3, (k + 100000).cast("string")),
                  td(4, F.upper(F.replace("p_name", F.lit(" "), F.lit("-")))),
                  td(5, _escape(F.concat(F.col("p_type"), F.lit(" & "), F.col("p_brand")))),
                  td(6, F.lit('<a href="#">More</a>')), F.lit("</tr>"))
    head = ("<html><body><table><thead><tr><th>flag</th><th>company</th><th>number</th>"
            "<th>code</th><th>branch</th><th>link</th></tr></thead><tbody>")
    rows = part.select(F.floor(k / SCREEN_ROWS_PER_PAGE).alias("page_id"), k, tr.alias("tr"))
    return (rows.groupBy("page_id")
            .agg(F.sort_array(F.collect_list(F.struct(k.alias("k"), F.col("tr")))).alias("trs"))
            .select("page_id", F.concat(F.lit(head), F.array_join("trs.tr", ""),
                                        F.lit("\n</tbody></table></body></html>")).alias("html")))


def bar_documents(raw: DataFrame, tasks: int | None = None) -> DataFrame:
    """Raw bar rows -> one API document ``{"data": [...]}`` per instrument
    and year (column ``value``) plus ``pair_id`` for the landing folder layout, so
    a document is bounded by the days of a year. ``tasks``: partitions to deal the instruments
    into; all documents of one are then in one task, which makes one file of them."""
    from barlens.schemas import RAW_BAR_PAYLOAD_FIELDS
    raw = raw.repartition(tasks, "pair_id") if tasks else raw
    payload = F.struct(*[F.col(c) for c in RAW_BAR_PAYLOAD_FIELDS])
    return (raw.groupBy("pair_id", F.year("row_date_timestamp").alias("_year"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("row_date_timestamp").alias("t"),
                                                      payload.alias("p")))).alias("ps"))
            .select("pair_id", F.to_json(F.struct(F.col("ps.p").alias("data"))).alias("value")))
