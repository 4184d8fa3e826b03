"""Hand-written fixtures in the raw and asset layouts."""

import datetime as dt

from barlens.schemas import ASSETS_INFO, RAW_BAR

T0 = dt.datetime(2024, 1, 1, 8, 0)


def raw_rows(spark, rows):
    """rows: (pair_id, day, close_text, loaded_at[, open_text, volume_text])."""
    out = []
    for r in rows:
        pid, day, close, loaded = r[:4]
        open_ = r[4] if len(r) > 4 else close
        vol = r[5] if len(r) > 5 else "100.0"
        ts = dt.datetime.combine(day, dt.time()) if day is not None else None
        out.append((pid, "greenFont", None, None, ts, close, open_, close, close, None, vol,
                    None, None, None, None, None, "0.00", loaded))
    return spark.createDataFrame(out, RAW_BAR)


def empty_raw(spark):
    return spark.createDataFrame([], RAW_BAR)


def assets(spark, rows):
    """rows: (pair_id, ticker, market_cap[, loaded_at])."""
    out = []
    for r in rows:
        pid, ticker, cap = r[:3]
        loaded = r[3] if len(r) > 3 else T0
        out.append((f"NSEI:{ticker}", pid, ticker, ticker, f"NSEI:{ticker}", "/p", "S",
                    cap, "Region", "Nation", loaded))
    return spark.createDataFrame(out, ASSETS_INFO)


def days(n, start=dt.date(2024, 1, 1)):
    return [start + dt.timedelta(days=i) for i in range(n)]
