"""Questions that blocks of documents ask of the whole corpus, answered in bits.

Documents are dealt into blocks of a few megabytes by a hash. A block works out keys from its texts and
sends its distinct keys, in order and packed by key range into cells; for each range one task compares the
cells of all blocks and answers with one bit for each key. The block, whose texts are in the same shuffle
partition as before, works out the same keys again and reads the bits in order. So a key that occurs in
a third of all documents is one entry per block, no task sees more than a range of keys or a block,
and hardly anything is sent back.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import whole

BLOCK_BYTES = 8 << 20
REPLY = "block long, bucket long, kind int, bits binary"


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """``block``, ``doc_id`` and ``text`` of all documents, and the number of blocks."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(2 * partitions, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))
    return docs.select(block.alias("block"), "doc_id", whole("text").alias("text")), n


def ordered(block: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The block's rows by id and text, so that they are in one order however they arrived, and the ids;
    a null id comes after all others."""
    at = pc.sort_indices(block, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_end")
    block = block.take(at)
    ids = block.column("doc_id").cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()
    return block, ids


def bucket_of(key: np.ndarray, n: int) -> np.ndarray:
    """The range of each 64-bit key, in the order of the keys."""
    return ((key >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def cell_edges(sorted_keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that sorted keys fall into, and where each begins, with the end."""
    buckets, first = np.unique(bucket_of(sorted_keys, n), return_index=True)
    return buckets, np.append(first, len(sorted_keys))


def groups_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by the keys, first the most important, and where each group of equal keys begins."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    if not len(order):
        return order, order
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(new)


def bits_of(replies: pa.Table, sorted_keys: np.ndarray, n: int, kind: int = 0) -> np.ndarray:
    """The answers for a block's sorted distinct keys."""
    out = np.zeros(len(sorted_keys), bool)
    buckets, edges = cell_edges(sorted_keys, n)
    place = dict(zip(buckets.tolist(), zip(edges[:-1].tolist(), edges[1:].tolist())))
    for bucket, of_kind, bits in zip(*(replies.column(c) for c in ("bucket", "kind", "bits"))):
        if of_kind.as_py() == kind:
            a, b = place[bucket.as_py()]
            out[a:b] = np.unpackbits(np.frombuffer(bits.as_py(), np.uint8), count=b - a).astype(bool)
    return out


def answered(cells: DataFrame, answer: Callable[[pa.Table], list[np.ndarray]]) -> DataFrame:
    """The replies to ``cells``: ``answer`` gets the cells of a range and gives the bits of each."""

    def run(table: pa.Table) -> pa.Table:
        bits = [np.packbits(b).tobytes() for b in answer(table)]
        kinds = pa.array(np.zeros(len(bits), np.int32))
        return pa.table([table.column("block"), table.column("bucket"), kinds, pa.array(bits, pa.binary())], ["block", "bucket", "kind", "bits"])

    return cells.groupBy("bucket").applyInArrow(run, REPLY)


def joined(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of a binary column end to end, and where each begins, with the end."""
    parts = [np.frombuffer(x.as_py(), dtype) for x in column]
    edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), edges
