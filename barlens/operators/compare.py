"""MDL-11: strategy roll-up by buy year and cap bucket, with four rankings.

The roll-up has at most (#years x #cap buckets x #strategies) rows - a few
thousand whatever the trade volume - so after the distributed aggregation it
is moved into one partition (a shuffle of only the final roll-up rows) and
all four rankings run there without further shuffles. Every ranking has a tie-break, so ranks are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def strategy_rollup(*trades: DataFrame) -> DataFrame:
    """AGG-2 + SET-3: P&L sum and trade count per (year, cap bucket, strategy)."""
    cols = ["buy_year", "market_cap_category", "strategy", "profit_or_loss"]
    union = trades[0].select(*cols)
    for t in trades[1:]:
        union = union.unionByName(t.select(*cols))
    return (union.groupBy("buy_year", "market_cap_category", "strategy")
            .agg(F.sum("profit_or_loss").alias("pl"),
                 F.count(F.lit(1)).alias("no_of_trades")))


def compare_strategies(*trades: DataFrame) -> DataFrame:
    """WIN-4..7 over the roll-up."""
    pl = F.col("pl").desc_nulls_last()

    def rank(part, *ties):
        return F.row_number().over(Window.partitionBy(*part).orderBy(pl, *ties))

    return (strategy_rollup(*trades).repartition(1)
            .withColumn("rank_best_strategy_for_market",
                        rank(["market_cap_category", "buy_year"], "strategy"))
            .withColumn("rank_best_market_for_strategy",
                        rank(["strategy", "buy_year"], "market_cap_category"))
            .withColumn("rank_best_market_for_strategy_overall",
                        rank(["strategy"], "buy_year", "market_cap_category"))
            .withColumn("rank_best_strategy_for_market_overall",
                        rank(["market_cap_category"], "buy_year", "strategy")))
