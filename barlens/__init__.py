"""barlens: price-bar analytics on Spark.

Every operator is a DataFrame -> DataFrame function; see README.md.
"""

from barlens.operators.bars import bars_between, dedup_bars, typed_feeds, unify_bars  # noqa: F401
from barlens.operators.compare import compare_strategies, strategy_rollup  # noqa: F401
from barlens.operators.ema import (apply_delivery, ema_resume, ema_state,  # noqa: F401
                                   rebuild_series, with_ema)
from barlens.operators.indicators import (daily_liquid_bars, liquid, volume_spikes,  # noqa: F401
                                          with_prev, with_seq, with_sma)
from barlens.operators.signals import with_crossovers  # noqa: F401
from barlens.operators.trades import pair_trades  # noqa: F401
from barlens.operators.universe import pending, universe  # noqa: F401
from barlens.session import get_spark, ship_package  # noqa: F401

__version__ = "0.1.0"
