"""Shared helpers: table access, column names that cannot clash, byte-level
word splitting, balanced distributed numbering."""

from __future__ import annotations

from math import isqrt

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def with_result(df: DataFrame, **cols: Column) -> DataFrame:
    """Add result columns; an input column of the same name gives way."""
    new = {c.lower() for c in cols}
    clash = [c for c in df.columns if c.lower() in new]
    tmp = {c: fresh(df, f"result_{c}") for c in cols}
    out = df.withColumns({tmp[c]: e for c, e in cols.items()}).drop(*clash)
    return out.withColumnsRenamed({t: c for c, t in tmp.items()})


def settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` plus a column that is computed once per row. An ordinary projection may be
    merged into a later lambda function and be computed again for every element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def text_crc(col: str) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes of a string column (null: null)."""
    return F.crc32(F.col(col).cast("binary"))


def id_crc(col: str = "doc_id") -> Column:
    """Unsigned CRC-32 of an id written as text (null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; forgets everything when it grows large,
    so a worker's memory stays bounded on any vocabulary."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(words: list, memo: WordHashes) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective, wraps)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def hex_number(digest: Column, digits: int) -> Column:
    """The first hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def balanced_buckets(rows: int) -> int:
    """Buckets of the two-level numbering: both the rows of a bucket and the
    buckets of a group grow with the square root of the table."""
    return max(1, isqrt(rows) // 16)


def running_starts(rows: DataFrame, group: list[str], bucket: str, order: list, weight: str,
                   out: str) -> DataFrame:
    """``out`` = sum of ``weight`` over all earlier rows of the same group.

    Rows are ordered by (bucket, order) within ``group``. The sum is taken in
    two levels, so no group, however large, is sorted or summed in one task:
    each (group, bucket) is summed on its own, and only the bucket totals
    (one row per group and bucket) are summed along the group.
    """
    totals = rows.groupBy(*group, bucket).agg(F.sum(weight).alias("__total"))
    along = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)], F.col(bucket).alias("__gb"),
        F.coalesce(F.sum("__total").over(along), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = F.col(bucket) == F.col("__gb")
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    return (rows.withColumn(out, F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .join(starts, on)
            .withColumn(out, F.col(out) + F.col("__start"))
            .drop("__start", "__gb", *[f"__g{i}" for i in range(len(group))]))
