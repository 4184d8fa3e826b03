"""SNK-6 / SRC-5: the unified bars as a stored, bucketed table.

``store_hub`` writes ``stock_data`` as a catalog table that is partitioned by frequency, bucketed by
instrument and sorted by series and date within each bucket (one file for each). Whatever is keyed by
instrument, or by more than it (the series windows of SMA, EMA and volume spikes, trade
pairing, liquidity), then runs on the buckets as they lie: no exchange of bars under any
of these models, however many of them read the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlens.operators.indicators import ORDER_COL, SERIES_KEYS

BUCKET_KEY = "pair_id"


def store_hub(stock: DataFrame, name: str, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write ``stock`` as the hub table ``name`` (at ``path``, else in the warehouse) and return it.

    ``buckets`` defaults to the session's shuffle partitions: choose it so that one bucket of
    a frequency fits a task's memory; on a large cluster some ten thousand.
    """
    spark = stock.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt as the buckets are, so that each bucket becomes one file
    writer = (stock.repartition(n, BUCKET_KEY).write.mode("overwrite").partitionBy("frequency")
              .bucketBy(n, BUCKET_KEY).sortBy(*SERIES_KEYS, ORDER_COL).option("partitionOverwriteMode", "static"))
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def read_hub(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
