"""Explicit schemas for every input and output table.

Inputs are never schema-inferred: the raw bar tables are fixed, and the asset
document is read by name against ASSETS_DOCUMENT.
"""

from pyspark.sql import types as T

S = T.StringType()

# The 16 payload fields of a landed bar, in payload order. Headerless CSV maps
# by this position; JSON maps by name.
RAW_BAR_PAYLOAD_FIELDS = [
    "direction_color", "row_date", "row_date_raw", "row_date_timestamp",
    "last_close", "last_open", "last_max", "last_min", "volume", "volume_raw",
    "change_percent", "last_close_raw", "last_open_raw", "last_max_raw",
    "last_min_raw", "change_percent_raw",
]

RAW_BAR_PAYLOAD = T.StructType([
    T.StructField(f, T.TimestampNTZType() if f == "row_date_timestamp" else S)
    for f in RAW_BAR_PAYLOAD_FIELDS
])

# A stored raw bar: instrument id, the payload, and the load time.
RAW_BAR = T.StructType(
    [T.StructField("pair_id", T.LongType())]
    + list(RAW_BAR_PAYLOAD.fields)
    + [T.StructField("record_created_on", T.TimestampNTZType())]
)

# The landed API document of one instrument: {"data": [payload, ...]}.
BAR_DOCUMENT = T.StructType([T.StructField("data", T.ArrayType(RAW_BAR_PAYLOAD))])

_ASSET = T.StructType([
    T.StructField("hidden", T.BooleanType()),
    T.StructField("uid", S),
    T.StructField("pairID", T.LongType()),
    T.StructField("ticker", S),
    T.StructField("name", S),
    T.StructField("primary", S),
    T.StructField("path", S),
    T.StructField("logo", S),
    T.StructField("logoDark", S),
    T.StructField("sector", S),
])

_ASSET_DATUM = T.StructType([
    T.StructField("hidden", T.BooleanType()),
    T.StructField("value", S),
    # `raw` holds numbers and strings in the source; read it as text.
    T.StructField("raw", S),
    T.StructField("sentiment", T.LongType()),
    T.StructField("currency", S),
    T.StructField("path", S),
])

ASSETS_DOCUMENT = T.StructType([
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("asset", _ASSET),
        T.StructField("data", T.ArrayType(_ASSET_DATUM)),
    ])))
])

ASSETS_INFO = T.StructType([
    T.StructField("uid", S),
    T.StructField("pair_id", T.LongType()),
    T.StructField("ticker", S),
    T.StructField("stock_name", S),
    T.StructField("primary_uid", S),
    T.StructField("path", S),
    T.StructField("sector", S),
    T.StructField("market_cap", T.DecimalType(24, 4)),
    T.StructField("primary_sector", S),
    T.StructField("secondary_sector", S),
    T.StructField("record_created_on", T.TimestampNTZType()),
])

SCREEN = T.StructType([
    T.StructField("halal_ind", S),
    T.StructField("stock_name", S),
    T.StructField("bse_code", S),
    T.StructField("nse_code", S),
    T.StructField("industry", S),
    T.StructField("record_created_on", T.TimestampNTZType()),
])

PRICE = T.DecimalType(10, 4)
MARKET_CAP = T.DecimalType(24, 4)

# Columns of the unified bar table, in output order.
STOCK_DATA_COLUMNS = [
    "pair_id", "transaction_id", "transaction_date", "last_open", "last_close",
    "last_min", "last_max", "volume", "change_percent", "frequency", "uid",
    "primary_uid", "ticker", "stock_name", "sector", "primary_sector",
    "secondary_sector", "market_cap", "market_cap_category", "quarter_start",
    "record_created_on", "row_num",
]

# Columns carried from the unified bars into indicator and trade tables.
BAR_ATTRIBUTES = [
    "pair_id", "ticker", "stock_name", "primary_uid", "primary_sector",
    "secondary_sector", "market_cap", "market_cap_category",
]
