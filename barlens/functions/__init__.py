"""Column-level functions: pure Catalyst expressions, no Python per row."""

from barlens.functions.scalar import (  # noqa: F401
    CAP_LABELS,
    after_first_colon,
    cap_bucket,
    crossover,
    decode_entities,
    normalize_code,
    parse_count,
    parse_price,
    quarter_start,
    strip_space,
    wall_clock,
    year_text,
    yyyymmdd,
)
from barlens.functions.money import pnl_columns, NOTIONAL  # noqa: F401
