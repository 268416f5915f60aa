"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has a bit set if more than half of its shingles' hashes have it set. Two
fingerprints that differ in at most ``distance`` bits have a common neighbour within half of that
distance of both (rounded up for one of them). So every distinct fingerprint emits all variants within
that radius, a shuffle brings equal variants together, and each meeting gives links, which are made
distinct and verified by their bit distance. The members that meet at one variant are linked to the
smallest of them, not all to all: at an even distance any two of them are linked anyway.

Groups are connected components of the links, found by rounds of large-star and small-star steps.

Defined results: a null text is empty and has fingerprint zero; null ids are never a component's id
unless no row of it has another; equal rows have equal results, and of those ``keep_one`` keeps one; very
long texts are hashed whole; other columns, whatever their names, go through ``keep_one`` as they are; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import free_name, stored, table

SHINGLE_WORDS = 3
DISTANCE = 2
_LOWER = bytes(range(256)).lower()


def _fingerprint(text: str | None, width: int) -> int:
    """Majority of the shingles' hash bits; the words are those between ASCII white space."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(b" ".join(words), 42)]
    else:
        hashes = [digest(b" ".join(words[i : i + width]), 42) for i in range(len(words) - width + 1)]
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[at : at + (1 << 14)], np.uint64)
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int, name: str = "fp") -> DataFrame:
    """``docs`` without its text, with the fingerprint as a signed 64-bit number."""
    rest = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (_fingerprint(t.as_py(), width) for t in batch.column("text")), np.uint64, batch.num_rows
            )
            columns = [batch.column(c) for c in rest] + [pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*rest, name])

    return docs.mapInArrow(run, schema)


def ball(radius: int) -> list[int]:
    """All masks of at most ``radius`` of 64 bits, as signed numbers."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``a < b`` between the distinct fingerprints ``fp``, which connect all that are near."""
    if distance % 2:
        raise ValueError("the distance must be even")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(distance // 2)])
    variants = prints.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")
    )
    met = variants.groupBy("variant").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("near"))
    pairs = met.where(F.size("near") > 1).select("a", F.explode("near").alias("b")).where("a < b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node with a link; the root is the smallest node of the component.

    A large-star step links every larger neighbour of a node to the smallest of its neighbourhood, a
    small-star step does so with the smaller ones; both are one aggregation and one join. The rounds
    end when nothing changes, after about the logarithm of the longest path.
    """

    def state(df: DataFrame) -> tuple:
        # The set of links, as far as a count and two sums of hashes tell it.
        row = df.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("b", "a").cast("long"))
        ).first()
        return tuple(row)

    now = stored(edges, "simhash-links")
    before, mark = None, state(now)
    while mark[0] and mark != before:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # Small star: the smaller neighbours of a node, and the node itself, go to the smallest of them.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        own = low.select(F.col("m").alias("a"), "b")
        rest = large.join(low, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        now = stored(own.union(rest).distinct(), "simhash-links")
        before, mark = mark, state(now)
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))


def with_component(prints: DataFrame, distance: int, least: str) -> DataFrame:
    """Adds ``component``, the smallest value of ``least`` (nulls last) among all rows that are linked."""
    distinct = stored(
        prints.groupBy("fp").agg(F.min(least).alias("least")), "simhash-distinct"
    )
    roots = components(links(distinct, distance))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of_print = rooted.join(lowest, "root").select(F.col("fp").alias("fp_"), "component")
    return prints.join(of_print, prints["fp"] == of_print["fp_"]).drop("fp_")


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row per document: its id, its fingerprint in hex and the smallest id of its group."""
    prints = stored(fingerprints(docs.select("doc_id", "text"), width), "simhash-prints")
    return with_component(prints, distance, "doc_id").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def keep_one(docs: DataFrame, width: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """One document of each group, that with the smallest id, with the columns it came with."""
    key, copies = free_name(docs, "row_key"), free_name(docs, "row_copies")
    own_key = F.md5(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}))
    keyed = docs.select("doc_id", own_key.alias(key), "text")
    prints = stored(fingerprints(keyed, width), "simhash-prints")
    # A null id comes after all others; rows that are equal in all columns have one key.
    ranked = prints.select(
        "fp", F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col(key).alias("k")).alias("rank")
    )
    chosen = with_component(ranked, distance, "rank").where("rank = component")
    winners = stored(chosen.groupBy(F.col("rank.k").alias(key)).agg(F.count("*").alias(copies)), "simhash-winners")
    kept = docs.withColumn(key, own_key).join(winners, key)
    once = kept.where(F.col(copies) == 1).select(*docs.columns)
    return once.union(kept.where(F.col(copies) > 1).dropDuplicates([key]).select(*docs.columns))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
