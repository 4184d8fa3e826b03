"""Trade profit-and-loss in exact decimal arithmetic.

All three figures stay DECIMAL end to end so the result does not depend on
evaluation order or engine float rounding; ``round`` is HALF_UP on decimals.
Shares are rounded for display only: profit uses the unrounded quotient.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: money put into every trade.
NOTIONAL = Decimal("100000.0")


def pnl_columns(buy: str = "buy_price", sell: str = "sell_price",
                notional: Decimal = NOTIONAL) -> dict[str, Column]:
    b, s, n = F.col(buy), F.col(sell), F.lit(Decimal(notional))
    shares = F.try_divide(n, b)           # a zero buy price gives NULL, not an error
    return {
        "shares_bought": F.round(shares, 2),
        "profit_or_loss": F.round(shares * s - n, 2),
        "percent_profit_loss": F.round(F.try_divide(s - b, b) * F.lit(100), 2),
    }
