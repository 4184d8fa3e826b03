"""MDL-1 / MDL-2: the compliant instrument universe and what is left to load.

The screen matches an asset when its code equals the part after the first
colon of either the listing id or the primary id. Written as an OR join this
is a nested-loop join; here each asset contributes one row per id
(``explode``), which turns it into an equi-join, then ``distinct``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.functions import after_first_colon, normalize_code
from barlens.functions.sqlexpr import run_sql


def compliant_codes(screen: DataFrame, flag_value: str = "True") -> DataFrame:
    """Distinct normalised codes of compliant screen rows (FLT-2, SC-1, AGG-4)."""
    return (screen.filter(F.col("halal_ind") == flag_value)
            .select(normalize_code("nse_code").alias("code"))
            .distinct())


def universe(screen: DataFrame, assets: DataFrame) -> DataFrame:
    """pair_ids of compliant assets, one row each."""
    ids = assets.select(
        "pair_id",
        F.explode(F.array(after_first_colon("uid"), after_first_colon("primary_uid")))
        .alias("code"))
    # both sides grow with the instrument count: adaptive execution broadcasts
    # one only where its measured bytes allow it
    return (ids.filter(F.col("code").isNotNull()).join(compliant_codes(screen), "code")
            .select("pair_id")
            .distinct())


def pending(universe_ids: DataFrame, loaded: DataFrame, null_aware: bool = True) -> DataFrame:
    """Universe minus instruments already loaded (SET-4, JN-4).

    null_aware=True keeps SQL ``NOT IN`` semantics: one NULL pair_id among
    the loaded rows empties the result. null_aware=False is ``NOT EXISTS``.
    """
    if not null_aware:
        done = loaded.select(F.col("pair_id").alias("_done")).distinct()
        return universe_ids.join(done, universe_ids["pair_id"] == done["_done"], "left_anti")
    # SQL NOT IN: one NULL on the right makes the test unknown for every row; against an
    # empty right side every row (even a NULL one) passes. Both facts are scalar
    # subqueries of the same plan, so building it runs no job.
    return run_sql("""
        SELECT u.* FROM {u} u LEFT ANTI JOIN {l} l ON u.pair_id = l.pair_id
        WHERE (SELECT count_if(pair_id IS NULL) FROM {l}) = 0
          AND (u.pair_id IS NOT NULL OR (SELECT count(*) FROM {l}) = 0)""", u=universe_ids, l=loaded.select("pair_id"))
