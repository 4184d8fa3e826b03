"""ST-1 / ST-2 / ST-6: landed raw bars as a stream, upserted idempotently.

Each micro-batch is typed, reduced to its latest row per bar key and loaded into a
``MergeTable`` under its batch number: a replayed batch is recognised, a crash before
the pointer is written changes nothing. Every ``compact_every`` batches the stream folds
what they hold into the base, so a reader opens the base and at most that many
folders, and merges only the months they touch. A later batch outranks an earlier
one on equal load times.

``without_repeats`` drops re-delivered bars before that, under an event-time watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlens.operators.bars import dedup_bars, good_rows, quarantined_rows, type_bars
from barlens.schemas import RAW_BAR
from barlens.session import tasks_for
from barlens.versioned import PART, SLICE, MergeTable, VersionedTable, dealt_by_part

LANDING_SCHEMA = T.StructType([*RAW_BAR.fields, T.StructField("frequency", T.StringType())])


def stream_bars(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """ST-1: raw bar files (Parquet, RAW_BAR + ``frequency``) as a stream; ``max_files`` bounds
    what one micro-batch takes."""
    r = spark.readStream.schema(LANDING_SCHEMA).format("parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(landing)


#: Batches after which a live table folds them into its base.
COMPACT_EVERY = 8
WRITER = "bars"


#: Rows of a micro-batch that one task types, sorts and stores.
BATCH_ROWS = 125_000


def _month() -> Column:
    return F.concat_ws("-", "frequency", F.date_format("transaction_date", "yyyy-MM"))


def _latest_dealt(rows: DataFrame, tasks: int) -> DataFrame:
    """The latest row of each bar (``_source_rank`` decides between equal load times), dealt and sorted as the
    table is stored: one shuffle and one sort serve both."""
    return dedup_bars(dealt_by_part(rows, _month(), "pair_id", tasks), (PART, SLICE)).drop(SLICE)


def _latest(stored: DataFrame) -> DataFrame:
    return _latest_dealt(stored.withColumn("_source_rank", F.col("_batch")), tasks_for(stored))


def live_bars(spark: SparkSession, target: str) -> MergeTable:
    """The live bar table at ``target``, in parts of one frequency and month."""
    return MergeTable(spark, target, _latest, _month())


def quarantine(spark: SparkSession, target: str) -> VersionedTable:
    """Rows that the live table at ``target`` could not take."""
    return VersionedTable(spark, f"{target}_quarantine")


def upsert_latest(target: str, compact_every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """ST-2: the ``foreachBatch`` body for ``target``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        typed = type_bars(batch.withColumn("_source_rank", F.lit(batch_id)))
        told = Observation()
        # one pass keeps the bad rows and counts all
        seen = typed.observe(told, F.count(F.lit(1)).alias("rows"))
        new = quarantine(spark, target).append(quarantined_rows(seen), (WRITER, batch_id))
        rows = told.get["rows"] if new else typed.count()
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BATCH_ROWS))
        latest = _latest_dealt(good_rows(typed), tasks).withColumn("_batch", F.lit(batch_id).cast("bigint"))
        live_bars(spark, target).upsert(latest, (WRITER, batch_id), compact_every, merged=True)
    return run


def latest_view(spark: SparkSession, target: str, parts: Callable[[str], bool] | None = None) -> DataFrame:
    """The current table: the latest row per (pair_id, frequency, date). ``parts`` picks
    ``<frequency>-<yyyy-MM>`` parts; the files of others are not opened."""
    return live_bars(spark, target).latest(parts).drop("_batch")


def compact(spark: SparkSession, target: str, out: str | None = None) -> None:
    """Fold all loaded batches into the base now, or write the current table to ``out``."""
    if out is None:
        live_bars(spark, target).compact()
    else:
        latest_view(spark, target).write.mode("overwrite").parquet(out)


#: What may differ between two deliveries of one bar.
LOAD_STAMP = "record_created_on"


def without_repeats(stream: DataFrame, days: int = 15, arrived: Column | None = None) -> DataFrame:
    """ST-6: a stream of raw bars without the ones delivered before with the same content.

    Deliveries overlap, as every one brings the bars of the last ``days`` days again. A
    bar counts as repeated if its key *and* a digest of all its values, the load stamp
    aside, were seen; a correction has another digest and stays. The state forgets a bar
    ``days`` after it arrived, so it holds the bars of one such span whatever the
    length of the stream; a repeat after that passes, and the upsert takes it.

    The watermark runs over the time of arrival (by default the landed file's), not over
    the bar's date: files are taken in order of arrival, so a late correction of an old bar
    is new by this clock and isn't lost.
    """
    at = F.col("_metadata.file_modification_time") if arrived is None else arrived
    content = [c for c in stream.columns if c != LOAD_STAMP]
    return (stream.withColumn("_arrived", at.cast("timestamp"))
            .withColumn("_content", F.unhex(F.md5(F.to_json(F.struct(*content)).cast("binary"))))
            .withWatermark("_arrived", f"{days} days")
            .dropDuplicatesWithinWatermark(["pair_id", "frequency", "row_date_timestamp", "_content"])
            .drop("_arrived", "_content"))


def run_available_now(writer, spark: SparkSession | None = None, state_partitions: int | None = None,
                      conf: dict[str, str] | None = None) -> None:
    """Start a streaming write with ``trigger(availableNow=True)`` and wait for its end,
    however long the backlog takes.

    ``state_partitions`` sets the shuffle partitions the query starts with, which
    fixes its state-store partition count for the life of the checkpoint; ``conf``
    holds other settings it starts with (a query takes them over for good). The
    session's own values are restored at once.
    """
    held = dict(conf or {})
    if state_partitions:
        held["spark.sql.shuffle.partitions"] = str(state_partitions)
    previous = {k: spark.conf.get(k, None) for k in held} if spark is not None else {}
    for k in previous:
        spark.conf.set(k, held[k])
    try:
        q = writer.trigger(availableNow=True).start()
    finally:
        for k, v in previous.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
