"""DuckDB oracle SQL for the registered queries.

Each oracle states the expected result independently of the Spark plan:
the bar feeds are built directly in typed form (text rendering and parsing
are inverses), deduplication is a ``row_number`` over the union, the EMA is a
recursive CTE, trade pairing is the literal theta join, and Spark's exact
DECIMAL division/rounding is restated with integer arithmetic because DuckDB
divides decimals in DOUBLE.
"""

from __future__ import annotations

from barlens.functions.scalar import LARGE_CAP_ABOVE, MICRO_CAP_BELOW, MID_CAP_RANGE, SMALL_CAP_RANGE

# Fixed values shared with barlens.sources.testdata.
HIST_BEFORE = "DATE '2001-07-01'"
CUR_FROM = "DATE '2001-06-01'"
HIST_AT = "TIMESTAMP '2001-07-01 06:00:00'"
CUR_AT = "TIMESTAMP '2001-11-05 12:30:00'"
ASSETS_AT = "TIMESTAMP '2001-01-01 00:00:00'"


def round_div(num: str, den: str, scale: int) -> str:
    """round(num / den, scale) with HALF_UP (away from zero), for den > 0,
    num and den integer (HUGEINT) expressions; result is an exact integer
    scaled by 10^scale."""
    return (f"(sign({num}) * ((2 * abs({num}) * {_pow10(scale)} + ({den}))"
            f" // (2 * ({den}))))")


def scaled(int_expr: str, scale: int) -> str:
    """An integer scaled by 10^scale as an exact DECIMAL."""
    return f"(CAST({int_expr} AS DECIMAL(30,0)) * CAST(1e-{scale} AS DECIMAL({scale + 1},{scale})))"


def _pow10(n: int) -> str:
    return f"CAST('1{'0' * n}' AS HUGEINT)"


def _hround(x: str, from_scale: int, to_scale: int) -> str:
    """HALF_UP rescale of an integer at from_scale to to_scale."""
    d = _pow10(from_scale - to_scale)
    return f"(sign({x}) * ((2 * abs({x}) + {d}) // (2 * {d})))"


def pnl_sql(buy: str = "buy_price", sell: str = "sell_price") -> str:
    """shares_bought, profit_or_loss, percent_profit_loss exactly as Spark's
    DECIMAL arithmetic gives them: notional 100000.0 (decimal(7,1)) divided
    by a decimal(10,4) price is rounded HALF_UP to 12 places; the percent
    quotient to 15 places; results rounded HALF_UP to 2 places."""
    B = f"CAST({buy} * 10000 AS HUGEINT)"
    S = f"CAST({sell} * 10000 AS HUGEINT)"
    q12 = f"((2 * {_pow10(21)} + {B}) // (2 * {B}))"
    x16 = f"({q12} * {S} - {_pow10(21)})"
    d = f"({S} - {B})"
    r15 = f"(sign({d}) * ((2 * abs({d}) * {_pow10(15)} + {B}) // (2 * {B})))"
    # result types as Spark derives them for these decimal expressions
    return (f"CAST({scaled(_hround(q12, 12, 2), 2)} AS DECIMAL(13,2)) AS shares_bought, "
            f"CAST({scaled(_hround(x16, 16, 2), 2)} AS DECIMAL(21,2)) AS profit_or_loss, "
            f"CAST({scaled(_hround(f'({r15} * 100)', 15, 2), 2)} AS DECIMAL(18,2)) AS percent_profit_loss")


BARS_CTE = """
li AS (
  SELECT l_suppkey, l_shipdate, l_quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS p,
         {'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'd': l_quantity, 'e': l_extendedprice} AS k
  FROM lineitem),
bars AS (
  SELECT l_suppkey AS pair_id, CAST(l_shipdate AS DATE) AS transaction_date,
         CAST(SUM(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS volume,
         MIN(p) AS last_min, MAX(p) AS last_max,
         arg_min(p, k) AS last_open, arg_max(p, k) AS last_close
  FROM li GROUP BY 1, 2),
weekly AS (
  SELECT pair_id, CAST(date_trunc('week', transaction_date) AS DATE) AS transaction_date,
         CAST(SUM(volume) AS BIGINT) AS volume, MIN(last_min) AS last_min, MAX(last_max) AS last_max,
         arg_min(last_open, transaction_date) AS last_open,
         arg_max(last_close, transaction_date) AS last_close
  FROM bars GROUP BY 1, 2)"""

FEEDS_CTE = f"""
feed_rows AS (
  SELECT pair_id, transaction_date, last_open, last_close, last_min, last_max, volume,
         'daily' AS frequency, 0 AS src, {HIST_AT} AS loaded
  FROM bars WHERE transaction_date < {HIST_BEFORE}
  UNION ALL
  SELECT pair_id, transaction_date, last_open, last_close, last_min, last_max, volume,
         'weekly', 0, {HIST_AT}
  FROM weekly WHERE transaction_date < {HIST_BEFORE}
  UNION ALL
  SELECT pair_id, transaction_date, last_open, CAST(last_close + 0.01 AS DECIMAL(10,2)),
         last_min, last_max, volume, 'daily', 1, {CUR_AT}
  FROM bars WHERE transaction_date >= {CUR_FROM}
  UNION ALL
  SELECT pair_id, transaction_date, last_open, CAST(last_close + 0.01 AS DECIMAL(10,2)),
         last_min, last_max, volume, 'weekly', 1, {CUR_AT}
  FROM weekly WHERE transaction_date >= {CUR_FROM}),
typed AS (
  SELECT pair_id, transaction_date,
         CAST(last_open AS DECIMAL(10,4)) AS last_open,
         CAST(last_close AS DECIMAL(10,4)) AS last_close,
         CAST(last_min AS DECIMAL(10,4)) AS last_min,
         CAST(last_max AS DECIMAL(10,4)) AS last_max,
         volume,
         CAST({scaled(round_div('CAST((last_close - last_open) * 100 AS HUGEINT) * 100',
                                'CAST(last_open * 100 AS HUGEINT)', 2), 2)} AS VARCHAR) AS change_percent,
         frequency, src, loaded
  FROM feed_rows),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pair_id, frequency, transaction_date
                                 ORDER BY loaded DESC NULLS LAST, src DESC) AS rn
    FROM typed) WHERE rn = 1)"""

ASSETS_CTE = f"""
assets AS (
  SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'NSEI:' || upper(s_name)
              WHEN s_suppkey % 7 = 1 THEN upper(s_name)
              ELSE 'BOM:' || CAST(s_suppkey + 500000 AS VARCHAR) END AS uid,
         s_suppkey AS pair_id, s_name AS ticker, s_name AS stock_name,
         'NSEI:' || upper(s_name) AS primary_uid, '/equities/' || lower(s_name) AS path,
         n_name AS sector,
         CASE WHEN s_acctbal >= 0
              THEN CAST(CAST(s_acctbal AS DECIMAL(12,2)) * 300000000 AS DECIMAL(24,4)) END AS market_cap,
         r_name AS primary_sector, n_name AS secondary_sector, {ASSETS_AT} AS record_created_on
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
screen AS (
  SELECT CASE WHEN s_suppkey % 3 <> 0 THEN 'True' ELSE 'False' END AS halal_ind,
         s_name AS stock_name, '  ' || lower(s_name) || ' ' AS nse_code
  FROM supplier)"""

# Bounds and labels are the library's fixed values; the statement is DuckDB's own.
CAP_CASE = f"""CASE WHEN market_cap IS NULL THEN 'Unknown'
       WHEN market_cap > {LARGE_CAP_ABOVE} THEN 'Large Cap'
       WHEN market_cap BETWEEN {MID_CAP_RANGE[0]} AND {MID_CAP_RANGE[1]} THEN 'Mid Cap'
       WHEN market_cap BETWEEN {SMALL_CAP_RANGE[0]} AND {SMALL_CAP_RANGE[1]} THEN 'Small Cap'
       WHEN market_cap < {MICRO_CAP_BELOW} THEN 'Micro Cap'
       ELSE 'Other' END"""


def latest_cte(name: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pair_id, frequency, transaction_date
                                 ORDER BY loaded DESC NULLS LAST, src DESC) AS rn
    FROM typed WHERE {where}) WHERE rn = 1)"""


def stock_data_cte(name: str = "stock_data", latest: str = "latest") -> str:
    return STOCK_DATA_CTE.replace("stock_data AS (", f"{name} AS (", 1).replace(
        "FROM latest l", f"FROM {latest} l", 1)


STOCK_DATA_CTE = f"""
stock_data AS (
  SELECT l.pair_id, strftime(l.transaction_date, '%Y%m%d') AS transaction_id,
         l.transaction_date, l.last_open, l.last_close, l.last_min, l.last_max, l.volume,
         l.change_percent, l.frequency, a.uid, a.primary_uid, a.ticker, a.stock_name,
         a.sector, a.primary_sector, a.secondary_sector, a.market_cap,
         {CAP_CASE} AS market_cap_category,
         CAST(date_trunc('quarter', l.transaction_date) AS DATE) AS quarter_start,
         l.loaded AS record_created_on, CAST(1 AS INTEGER) AS row_num
  FROM latest l JOIN assets a ON l.pair_id = a.pair_id)"""


def with_ctes(*extra: str) -> str:
    parts = [BARS_CTE, FEEDS_CTE, ASSETS_CTE, STOCK_DATA_CTE, *extra]
    return "WITH RECURSIVE " + ",".join(p.strip("\n") for p in parts) + "\n"


def liquid_cte(threshold: float) -> str:
    return f"""
liquid AS (
  SELECT pair_id, CAST(SUM(volume) AS DOUBLE) / COUNT(volume) AS avg_volume
  FROM stock_data WHERE frequency = 'daily' GROUP BY pair_id
  HAVING CAST(SUM(volume) AS DOUBLE) / COUNT(volume) > {threshold!r}),
liquid_daily AS (
  SELECT * FROM stock_data
  WHERE frequency = 'daily' AND pair_id IN (SELECT pair_id FROM liquid))"""


def sma_expr(col: str, n: int, alias: str) -> str:
    w = (f"(PARTITION BY pair_id, ticker ORDER BY transaction_date "
         f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")
    return f"CAST(SUM({col}) OVER {w} AS DOUBLE) / COUNT({col}) OVER {w} AS {alias}"
