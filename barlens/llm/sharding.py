"""Sharding by jump consistent hashing (operator 8). DataFrame functions only.

A stable key is mapped to one of ``n`` shards without a ring table: a 64-bit
linear congruential sequence seeded by the key gives the ascending "jumps" at
which the key would move as shards are appended; the last jump below ``n`` is
the shard. Appending a shard moves only the rows whose next jump is exactly
the new shard, so they all go into it.

Spark checks bigint overflow, so the 64-bit state is kept as two 32-bit halves
and multiplied by 16-bit limbs; every product stays below 2**49.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlens.llm import common as C
from barlens.sinks import materialize

# Fixed values of the published jump consistent hash.
MULTIPLIER = 2862933555777941757
INCREMENT = 1

M32 = 0xFFFFFFFF


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (0 .. shards-1) of a bigint key; a null key counts as 0.

    The sequence has at most ``shards`` jumps below ``shards`` because each one is
    larger than the last, so ``shards`` folding steps always suffice.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    a_hi, a_lo = MULTIPLIER >> 32, MULTIPLIER & M32
    a_hi1, a_hi0 = a_hi >> 16, a_hi & 0xFFFF
    a_lo1, a_lo0 = a_lo >> 16, a_lo & 0xFFFF

    def long(x: int) -> Column:
        return F.lit(x).cast("bigint")

    def low_product(x: Column, limb1: int, limb0: int) -> Column:
        """(x * (limb1 * 2**16 + limb0)) mod 2**32 for x < 2**32."""
        upper = (x * long(limb1)).bitwiseAND(long(0xFFFF))
        return (x * long(limb0) + F.shiftleft(upper, 16)).bitwiseAND(long(M32))

    def step(s: Column, _i: Column) -> Column:
        hi, lo = s["hi"], s["lo"]
        upper = lo * long(a_lo1)
        sum_lo = lo * long(a_lo0) + long(INCREMENT) + F.shiftleft(upper.bitwiseAND(long(0xFFFF)), 16)
        carry = F.shiftright(sum_lo, 32) + F.shiftright(upper, 16)
        new_lo = sum_lo.bitwiseAND(long(M32))
        new_hi = (carry + low_product(lo, a_hi1, a_hi0) + low_product(hi, a_lo1, a_lo0)).bitwiseAND(long(M32))
        # floor((b + 1) * 2**31 / ((state >> 33) + 1))
        jump = F.floor((s["j"] + long(1)).cast("double")
                       * (F.lit(float(1 << 31)) / (F.shiftright(new_hi, 1) + long(1)).cast("double")))
        # past the last jump nothing changes any more
        done = s["j"] >= long(shards)
        return F.struct(new_hi.alias("hi"), new_lo.alias("lo"),
                        F.when(done, s["b"]).otherwise(s["j"]).alias("b"),
                        F.when(done, s["j"]).otherwise(jump.cast("bigint")).alias("j"))

    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(long(M32)).alias("lo"),
                     long(-1).alias("b"), long(0).alias("j"))
    # each step first takes over the previous jump, hence one more step
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), start, step, lambda s: s["b"].cast("int"))


def shard(docs: DataFrame, shards: int, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """All rows of ``docs`` with their shard. No shuffle, no state.

    Null keys count as key 0; repeated rows go to the same shard; texts (null,
    empty, very long) play no part; an empty table gives an empty table. An
    input column named like ``out`` gives way to the result. A key that holds a
    third of all rows puts them into one shard: the law demands it; writers then
    split the shard into several files.
    """
    return C.with_result(docs, **{out: jump_hash(F.col(key), shards)})


def slots(rows: DataFrame, shard_col: str, order: list[str]) -> DataFrame:
    """Number the rows of each shard 0, 1, 2, ... by (hash, order); column ``slot``.

    ``rows`` must consist of ``shard_col`` and the ``order`` columns (all that a row
    is identified by). Equal rows are counted, numbered as one and expanded again
    in chunks, so a row that repeats a billion times is no hot key. Within a shard
    the rows are cut by hash into buckets, see ``balanced_buckets``.
    """
    cols = [shard_col, *[c for c in order if c != shard_col]]
    counted = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    buckets = C.balanced_buckets(rows.count())
    spread = C.hex_number(F.md5(F.concat_ws(",", *[F.col(c).cast("string") for c in cols]).cast("binary")), 4)
    bucketed = counted.withColumn("__b", F.floor(spread * F.lit(buckets) / F.lit(65536)))
    starts = C.running_starts(bucketed, [shard_col], "__b", [F.col(c) for c in cols], "__n", "__slot0")
    chunk = 10_000
    lots = (starts.withColumn("__lot", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                            F.floor((F.col("__n") - 1) / chunk)))))
    first = F.col("__lot") * chunk
    each = F.sequence(first, F.least(F.col("__n") - 1, first + (chunk - 1)))
    return (lots.withColumn("__i", F.explode(each))
            .withColumn("slot", F.col("__slot0") + F.col("__i"))
            .drop("__n", "__b", "__slot0", "__lot", "__i"))


def digest(docs: DataFrame, shards: int) -> DataFrame:
    """Contract columns of the sharding of ``docs`` under the law ``key``.

    size: UTF-8 bytes of the text (null: none) plus 1; text_crc32: of the text's
    bytes (null: as the empty text). Equal texts with different ids may part: the
    id alone decides.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = shard(narrow, shards)
    # texts are read once; numbering works on the stored narrow rows
    placed = materialize(shard(placed, shards + 1, out="grown_shard"), "shard-rows")
    numbered = slots(placed, "shard", ["doc_id", "size", "text_crc32", "grown_shard"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
