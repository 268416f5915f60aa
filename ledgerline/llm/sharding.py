"""Sharding by best-fit-decreasing bin packing.

Documents with equal texts form an indivisible group. Groups are taken from the largest to the smallest,
and each enters the bin with the least remaining room that still holds it; the bins are kept in a
balanced tree ordered by their room, so each step takes logarithmic time.

Packing is sequential, so the number of items must not grow with the corpus. A group of at least
1/``resolution`` of a mean shard is an item of its own; smaller groups are first gathered by hash into
packets of about half that size, which stay together. That bounds the items by three times
``resolution`` per shard, whatever the number of documents, and the rule is the same at every size.

For a given number of shards the capacity is the smallest for which best fit needs no more shards,
found by bisection. Groups larger than a mean shard get a shard each and the others are packed without
them, so sizes are near equal as far as indivisible groups allow.

Defined results: a null text has size 8, checksum 0 and forms a group of its own; repeated rows are
rows of one group, each with its own slot, in any order among rows of one id and text; very long texts count with all
their bytes; other columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.llm.common import free_name, stored, table, whole

N_SHARDS = 24
#: Items per mean shard, the parameter that bounds the work of the driver.
RESOLUTION = 1000
#: Rows that one task numbers at a time.
SLOT_ROWS = 5000


class RoomTree:
    """Bins ordered by (room, bin) in a treap: balanced by priorities that are hashes of the bin."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _split(node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        own, priority, left, right = node
        if own < key:
            low, high = RoomTree._split(right, key)
            return (own, priority, left, low), high
        low, high = RoomTree._split(left, key)
        return low, (own, priority, high, right)

    @staticmethod
    def _merge(low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return low[0], low[1], low[2], RoomTree._merge(low[3], high)
        return high[0], high[1], RoomTree._merge(low, high[2]), high[3]

    def add(self, room: int, number: int) -> None:
        key = (room, number)
        low, high = self._split(self.root, key)
        priority = hashlib.md5(b"%d" % number).digest()
        self.root = self._merge(self._merge(low, (key, priority, None, None)), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and gives the bin with the least room of at least ``size``."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node = high
        while node[2] is not None:
            node = node[2]
        key = node[0]
        _, rest = self._split(high, (key[0], key[1] + 1))
        self.root = self._merge(low, rest)
        return key


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each size, for sizes in falling order; None if more than ``most`` bins are needed."""
    tree, bins, used = RoomTree(), [], 0
    for size in sizes:
        found = tree.take_tightest(size)
        if found is None:
            if used == most or size > capacity:
                return None
            found = (capacity, used)
            used += 1
        bins.append(found[1])
        tree.add(found[0] - size, found[1])
    return bins


def pack(sizes: list[int], n_bins: int, tolerance: float = 1e-4) -> list[int]:
    """Bins 0 to ``n_bins - 1`` for sizes in falling order, at the least capacity best fit manages.

    A size above the mean of what is left has a bin to itself, and does not raise the others' capacity.
    """
    rest, alone = sum(sizes), 0
    while alone < min(len(sizes), n_bins - 1) and sizes[alone] * (n_bins - alone) > rest:
        rest -= sizes[alone]
        alone += 1
    if alone:
        return [*range(alone), *(alone + b for b in pack(sizes[alone:], n_bins - alone, tolerance))]
    low = max([math.ceil(rest / n_bins), *sizes[:1]]) if sizes else 0
    found, high = best_fit(sizes, low, n_bins), low
    while found is None:  # the first capacity that does
        low, high = high, high + max(1, high // 256)
        found = best_fit(sizes, high, n_bins)
    while high - low > max(1, tolerance * high):
        middle = (low + high) // 2
        tried = best_fit(sizes, middle, n_bins)
        low, high, found = (low, middle, tried) if tried is not None else (middle, high, found)
    return found


def _items(rows: DataFrame, n_shards: int, resolution: int):
    """Large groups and packets with their sizes in falling order, and how a row finds its packet."""
    groups = stored(
        rows.groupBy("gid").agg(F.sum("size").alias("size")).select("gid", "size"), "shard-groups"
    )
    total, n_groups = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    least = total / (n_shards * resolution)  # a group of this size is an item of its own
    dust = groups.where(F.col("size") < least)
    dust_total = dust.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    n_packets = max(1, math.ceil(2 * dust_total / max(least, 1)))
    packet = F.pmod(F.xxhash64("gid"), F.lit(n_packets))
    # At most n_shards * resolution large groups and twice as many packets.
    large = groups.where(F.col("size") >= least).select("gid", F.lit(None).cast("long").alias("packet"), "size")
    packets = dust.groupBy(packet.alias("packet")).agg(F.sum("size").alias("size"))
    items = large.union(packets.select(F.lit(None).cast("string").alias("gid"), "packet", "size")).collect()
    items.sort(key=lambda r: (-r["size"], r["packet"] is None, r["packet"] or 0, r["gid"] or ""))
    return items, packet


def assigned(rows: DataFrame, n_shards: int = N_SHARDS, resolution: int = RESOLUTION) -> DataFrame:
    """Adds ``shard`` to rows of ``gid`` and ``size``."""
    spark = rows.sparkSession
    items, packet = _items(rows, n_shards, resolution)
    bins = pack([r["size"] for r in items], n_shards)
    whole_groups = [(r["gid"], b) for r, b in zip(items, bins) if r["gid"] is not None]
    packets = [(r["packet"], b) for r, b in zip(items, bins) if r["gid"] is None]
    # Both tables are bounded by the number of items, so they may be broadcast at every size.
    of_group = spark.createDataFrame(
        whole_groups, T.StructType([T.StructField("gid", T.StringType()), T.StructField("own", T.IntegerType())])
    )
    of_packet = spark.createDataFrame(
        packets, T.StructType([T.StructField("packet", T.LongType()), T.StructField("shared", T.IntegerType())])
    )
    return (
        rows.join(F.broadcast(of_group), "gid", "left")
        .withColumn("packet", packet)
        .join(F.broadcast(of_packet), "packet", "left")
        .withColumn("shard", F.coalesce("own", "shared"))
        .drop("own", "shared", "packet")
    )


def with_slots(rows: DataFrame, n_shards: int) -> DataFrame:
    """Adds ``slot``, counting the rows of each shard from 0.

    A shard's rows are dealt into pieces by hash, numbered within each piece, and shifted by the rows
    of the pieces before it; so no task sees a whole shard.
    """
    n_rows = rows.count()
    pieces = max(1, math.ceil(n_rows / (n_shards * SLOT_ROWS)))
    pieced = rows.withColumn("piece", F.pmod(F.xxhash64("doc_id", "gid"), F.lit(pieces)))
    counts = pieced.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stored(
        counts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")), "shard-shifts"
    )
    within = Window.partitionBy("shard", "piece").orderBy("doc_id", "gid")
    return (
        pieced.withColumn("slot", F.row_number().over(within) - 1)
        .join(shifts, ["shard", "piece"])
        .withColumn("slot", F.col("slot") + F.col("shift"))
        .drop("piece", "shift")
    )


def sharded(docs: DataFrame, n_shards: int = N_SHARDS, resolution: int = RESOLUTION) -> DataFrame:
    """One row per document with its shard and its slot there."""
    text = whole("text")
    rows = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("long") + 8).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.coalesce(F.md5("text"), F.lit("null")).alias("gid"),
        ),
        "shard-rows",
    )
    slotted = with_slots(stored(assigned(rows, n_shards, resolution), "shard-assigned"), n_shards)
    return slotted.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, resolution: int = RESOLUTION) -> None:
    """Writes the documents below ``path``, one folder ``shard=N`` each; a shard is several files."""
    shard, gid, size = (free_name(docs, n) for n in ("shard", "gid", "size"))
    own = {gid: F.coalesce(F.md5("text"), F.lit("null")), size: F.octet_length(whole("text")) + 8}
    keyed = docs.withColumns(own)
    rows = keyed.select(F.col(gid).alias("gid"), F.col(size).cast("long").alias("size"))
    of_group = stored(assigned(rows, n_shards, resolution).select("gid", "shard").distinct(), "shard-groups")
    of_group = of_group.select(F.col("gid").alias(gid), F.col("shard").alias(shard))
    keyed.join(of_group, gid).select(*docs.columns, shard).write.partitionBy(shard).parquet(path)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))
