"""From raw documents to shards of a training corpus, as five Spark stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All but the last return
the columns of documents; the last adds ``shard``.

1. language_id    documents in no learned language go
2. near_dedup     one document of each group of near-duplicates stays
3. decontaminate  documents that hold a benchmark item go
4. mix            each document as often as the mix takes it
5. shard          a stable shard for each row

The stages learn, count and decide on all documents they are given. SQL can't
express the first stage (a trained classifier), so there is no ORACLE_SQL; the
result is tested against a brute-force version instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlens.llm import decontamination, language_id, mixing, near_dup, sharding
from barlens.llm.common import table
from barlens.session import ship_package
from barlens.sinks import materialize

#: Least share of the winning language in a document's scores; below it no language fits.
MIN_LANGUAGE_SCORE = 0.3
SHARDS = 8

ORACLE_SQL = None


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return language_id.filter_language(docs, MIN_LANGUAGE_SCORE)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_dup.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_languages),
    ("near_dedup", deduplicate),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
