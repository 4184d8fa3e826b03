"""Sinks and materialisations (SNK-1 .. SNK-10).

A target is either a catalog table name or a path (anything containing
``/``). Paths should live in shared storage; ``materialize`` writes under the
cluster's ``spark.checkpoint.dir``.

Overwrites are per partition where the data is partitioned
(``partitionOverwriteMode=dynamic``), so reloading one window of bars
replaces exactly the partitions it touches, atomically per partition,
instead of truncating the whole table first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlens.functions import wall_clock
from barlens.session import scratch_path
from barlens.versioned import VersionedTable


def _is_path(target: str) -> bool:
    return "/" in target


def _writer(df: DataFrame, mode: str, partition_by=()):
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def exists(spark: SparkSession, target: str) -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(target)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def replace_table(df: DataFrame, target: str, partition_by=()) -> None:
    """SNK-1 / SNK-6: replace the whole table."""
    w = _writer(df, "overwrite", partition_by).option("partitionOverwriteMode", "static")
    w.parquet(target) if _is_path(target) else w.saveAsTable(target)


def append_rows(df: DataFrame, target: str, partition_by=()) -> None:
    """Append; the table is created from the frame's schema when absent (SNK-4)."""
    w = _writer(df, "append", partition_by)
    w.parquet(target) if _is_path(target) else w.saveAsTable(target)


def append_bars(df: DataFrame, target: str, pair_id=None, loaded_at=None,
                partition_by=()) -> None:
    """SNK-2: stamp instrument (when given) and one load time for the whole
    batch, then append in one job."""
    out = df
    if pair_id is not None:
        out = out.withColumn("pair_id", F.lit(pair_id).cast("bigint"))
    stamp = wall_clock(loaded_at) if loaded_at is not None else F.localtimestamp()
    append_rows(out.withColumn("record_created_on", stamp), target, partition_by)


def reload_partitions(df: DataFrame, target: str, partition_by) -> None:
    """SNK-3: replace only the partitions present in ``df``."""
    if _is_path(target):
        (_writer(df, "overwrite", partition_by)
         .option("partitionOverwriteMode", "dynamic").parquet(target))
    else:   # a catalog table already knows its partition columns
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .insertInto(target))


def delete_all(spark: SparkSession, target: str, partition_by=()) -> None:
    """SNK-5: remove every row, keep the schema."""
    if not _is_path(target):
        if spark.catalog.getTable(target).tableType == "MANAGED":
            spark.sql(f"TRUNCATE TABLE {target}")
            return
        # TRUNCATE refuses external tables; a static overwrite by no rows empties all
        # their partitions (insertInto takes the mode from the session only)
        key = "spark.sql.sources.partitionOverwriteMode"
        mode = spark.conf.get(key)
        spark.conf.set(key, "static")
        try:
            spark.createDataFrame([], spark.table(target).schema).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(key, mode)
        return
    # Reading and overwriting one path in one job is not allowed; the empty
    # frame is made from the schema alone. Its partition columns stay ordinary
    # columns of the empty table; a later partitioned write restores the layout.
    replace_table(spark.createDataFrame([], read_target(spark, target).schema), target, partition_by)


def append_newer(spark: SparkSession, df: DataFrame, target: str,
                 date_col: str = "transaction_date", per_key: list[str] | None = None) -> DataFrame:
    """SNK-7 + FLT-7: append the rows above the target's high-water mark.

    per_key=None is the reference's global mark (one scalar); with key
    columns each key has its own mark (a lagging instrument keeps loading).
    Returns the appended rows.
    """
    if not exists(spark, target):
        newer = df
    elif per_key is None:
        mark = read_target(spark, target).agg(F.max(date_col)).scalar()
        newer = df.filter(mark.isNull() | (F.col(date_col) > mark))
    else:
        marks = (read_target(spark, target).groupBy(*per_key)
                 .agg(F.max(date_col).alias("_hw")))
        newer = (df.join(marks, per_key, "left")
                 .filter(F.col("_hw").isNull() | (F.col(date_col) > F.col("_hw")))
                 .drop("_hw"))
    # stored before the append: what is returned must not be computed again from
    # the target it was appended to
    newer = materialize(newer, "append-newer")
    append_rows(newer, target)
    return newer


def publish(spark: SparkSession, df: DataFrame, path: str, load_id: str, mode: str = "append",
            pair_id=None, loaded_at=None, validate=None) -> bool:
    """SNK-2 / SNK-3 as a ``VersionedTable`` at ``path``: stage the stamped rows, validate them, and
    make them part of the table (``append``) or the table itself (``replace``) in one step.
    A load that is there already is recognised by ``load_id`` and does nothing (False)."""
    if mode not in ("append", "replace"):
        raise ValueError(f"mode is append or replace, not {mode}")
    out = df if pair_id is None else df.withColumn("pair_id", F.lit(pair_id).cast("bigint"))
    stamp = wall_clock(loaded_at) if loaded_at is not None else F.localtimestamp()
    out = out.withColumn("record_created_on", stamp)
    table = VersionedTable(spark, path)
    return (table.append if mode == "append" else table.replace)(out, load_id, validate)


def write_sorted(df: DataFrame, order: list[Column], position: str = "position", target: str | None = None) -> DataFrame:
    """SRT-1..3: ``df`` in total order, with each row's ``position`` from 1.

    Rows are dealt by ranges of ``order`` and sorted within each; the files of the stored
    table follow each other in order. A row's position is its place in its file plus the
    rows of all files before, so nothing is numbered in one task but one row per file.
    ``order`` must tell all rows apart for a determined result.
    """
    spark = df.sparkSession
    path = target or scratch_path(spark, "sorted")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumns({"_file": F.spark_partition_id(), "_place": place}).write.mode("overwrite").parquet(path))
    stored = spark.read.parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (stored.groupBy(F.col("_file").alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    # one row per written file
    return (stored.join(F.broadcast(starts), F.col("_file") == F.col("_range"))
            .withColumn(position, F.col("_start") + F.col("_place") + 1).drop("_file", "_place", "_range", "_start"))


def as_view(df: DataFrame, name: str) -> None:
    """SNK-8: the default (view) materialisation."""
    df.createOrReplaceTempView(name)


#: How staged text is stored: gzip takes a fifth to a ninth of it. One task reads such a file as a whole, so a
#: file ends after so many rows.
STAGED = {"compression": "gzip", "maxRecordsPerFile": 250_000}
#: The same where a folder is written for each instrument, and files are small and many: on a local file system no file
#: of checksums lies beside each (gzip has its own).
STAGED_FOLDERS = {**STAGED, "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_csv(df: DataFrame, path: str, header: bool = True, **stored) -> None:
    """SNK-10: staging CSV with a header line; ``stored``: the writer's options, such as ``STAGED``."""
    df.write.mode("overwrite").options(**stored).option("header", header).csv(path)


def create_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by=()) -> None:
    """SNK-9: create an empty table of a fixed schema if it does not exist."""
    if exists(spark, name):
        return
    empty = spark.createDataFrame([], schema)
    w = _writer(empty, "ignore", partition_by)
    w.parquet(name) if _is_path(name) else w.saveAsTable(name)


def materialize(df: DataFrame, name: str, partition_by=()) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    later jobs start from the written table (lineage cut, survives executor
    loss) instead of recomputing the plan."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _writer(df, "overwrite", partition_by).parquet(path)
    return spark.read.parquet(path)
