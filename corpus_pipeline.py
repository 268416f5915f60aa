"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as
the next stage's docs. All but the last give the columns of ``documents``; the last gives one row per
document that is left, with its shard and slot.

Defined results: null and empty texts fail the fixed rules; rows that are equal in all columns are kept or left
together, but for the near-dedup, which keeps one; ties go by the smallest id, nulls last; very long texts are
treated whole; extra columns go through whatever their names; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, mixing, quality_rules, sharding, simhash
from ledgerline.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the fixed rules and the adaptive thresholds reject, by the rules of op9."""
    return quality_rules.keep_good(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash group."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that share a passage with the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics have their target weights, by the rule of op1.

    Values too small for their target are kept whole, so that they do not set the size of the sample.
    """
    return mixing.mixed_sample(docs, mixing.PRODUCTION)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into shards of near equal bytes."""
    return sharding.sharded(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL has no XXH64 and no best-fit packing; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
