"""One registered query per operator, over whole tables, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from barlens.llm import (chat, decontamination, language_id, license_scan, line_dedup, mixing, near_dup, oracles, periodic_runs,
                         quality, sharding, spelling, topk, toxicity)
from barlens.llm.common import table

SHARDS = 8


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language_id.digest(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.digest(table(spark, sf_dir, "documents"), weights=mixing.WEIGHTS)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label posterior, score and decision for every document."""
    return quality.classify(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates found in every document."""
    return license_scan.digest(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers, names and units."""
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count, component and representative of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and next shard of every document."""
    return sharding.digest(table(spark, sf_dir, "documents"), SHARDS)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every query vector."""
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its packed form."""
    return chat.digest(chat.with_trap(table(spark, sf_dir, "conversations")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of which are made periodic."""
    return periodic_runs.digest(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stay elsewhere."""
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their more frequent forms."""
    return spelling.digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_mixing": op2_mixing,
        "op3_quality": op3_quality,
        "op4_license_scan": op4_license_scan,
        "op5_decontamination": op5_decontamination,
        "op6_toxicity": op6_toxicity,
        "op7_near_dup": op7_near_dup,
        "op8_sharding": op8_sharding,
        "op9_topk": op9_topk,
        "op10_chat": op10_chat,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_line_dedup": op12_line_dedup,
        "op13_spelling": op13_spelling,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    named = {
        "op2_mixing": mixing.SQL,
        "op4_license_scan": oracles.license_scan(),
        "op5_decontamination": oracles.decontamination(),
        "op7_near_dup": oracles.NEAR_DUP,
        "op8_sharding": oracles.sharding(SHARDS),
        "op9_topk": topk.SQL,
        "op10_chat": chat.SQL,
        "op12_line_dedup": line_dedup.SQL,
        "op13_spelling": oracles.SPELLING,
    }
    if corpus_pipeline.ORACLE_SQL is not None:
        named["pipeline"] = corpus_pipeline.ORACLE_SQL
    return named
