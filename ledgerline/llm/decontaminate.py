"""Benchmark decontamination by spaced-seed hashing.

A token is a run of letters and digits of the lower-cased text, so case and punctuation, also beyond ASCII,
do not matter; in scripts without blanks between words every character is a token. A seed is a mask over consecutive tokens that ignores some of them; two places at which
all other tokens agree have equal hashes. The hashes of all seeds of the benchmark are joined with those
of all documents; around every hit, document and item are laid side by side and compared token by token.
An overlap counts if, of ``window`` tokens side by side (or of a whole shorter item), at least
``least_equal`` are equal. So substituted tokens are tolerated wherever they fall. Where the start or end
of the document cuts off a part, fewer tokens lie side by side, of which as many must be equal.

The masks are chosen by the length of the item, such that every pattern of equal tokens that the default
rule accepts holds one of them; the tests go through all patterns.

Nearly all hashes of documents have no partner. A bitmap of fixed size with the benchmark's hashes
keeps them out of the shuffle: it only ever lets too many through, so results do not depend on its
size, and a large benchmark is joined by a shuffle like any other table.

Items of fewer than ``MIN_TOKENS`` tokens show no leak and are left out, and so do documents with fewer
tokens than must be equal. Defined results: null texts have no tokens and
match nothing; repeated rows and items give one pair each; very long texts are searched whole; other columns, whatever
their names, play no part and go through ``without_leaks`` as they are; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name, stored, table
from ledgerline.llm.quality_model import _KIND
from ledgerline.llm.text_arrays import byte_hashes, chunks, mixed, texts

#: Masks by the least tokens of the items they are for. Tokens with 1 are compared, those with 0 are not.
MASKS = {
    5: ("11011", "1111", "1100011", "11101", "10111"),
    9: ("111011", "110100011", "1001111", "111000101", "110111"),
    16: ("110110011", "1110010101", "1011100011", "1101001011", "110100000111", "1110111", "111000100101"),
}
MIN_TOKENS = min(MASKS)
#: Characters of scripts that put no blanks between words, with their marks.
_UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]\p{M}*)"
BITMAP_BITS = 24


@dataclass(frozen=True)
class Overlap:
    window: int = 16
    least_equal: float = 0.75
    margin: int = 32


def size_class(n: int) -> int:
    """The key of the masks for items of ``n`` tokens; 0 for none."""
    return max((least for least in MASKS if least <= n), default=0)


def all_masks() -> list[tuple[int, int, str]]:
    """Number, size class and pattern of every mask."""
    return [(number, *pair) for number, pair in enumerate((c, m) for c, masks in MASKS.items() for m in masks)]


def plain(text: str) -> Column:
    """The lower-cased text, with blanks for what is no letter, mark or digit beyond ASCII."""
    lower = F.lower(text)
    letters = F.regexp_replace(lower, r"[^\x00-\x7F\p{L}\p{M}\p{N}]+", " ")
    return F.when(lower.rlike(r"[^\x00-\x7F]"), F.regexp_replace(letters, _UNSPACED, " $1 ")).otherwise(lower)


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash and text number of every token."""
    kind = _KIND[raw]
    new = np.ones(len(raw), bool)
    if len(raw):
        new[1:] = kind[1:] != kind[:-1]
        edges = offsets[:-1]
        new[edges[edges < len(raw)]] = True
    cuts = np.append(np.flatnonzero(new), len(raw))
    starts, stops = cuts[:-1], cuts[1:]
    run = kind[starts] == 1
    starts, stops = starts[run], stops[run]
    return byte_hashes(raw, starts, stops), np.searchsorted(offsets, starts, "right") - 1


def seed_hashes(token: np.ndarray, doc: np.ndarray, number: int, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of every seed of a mask that lies within one text."""
    n = len(token) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, number + 1, np.uint64)
    for i, used in enumerate(mask):
        if used == "1":
            total *= np.uint64(0x9E3779B97F4A7C15)
            total += token[i : i + n]
    at = np.flatnonzero(doc[:n] == doc[len(mask) - 1 :])
    return at, mixed(total[at])


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the bitmap for each hash."""
    return (h >> np.uint64(64 - BITMAP_BITS)), (h >> np.uint64(8)) & np.uint64((1 << BITMAP_BITS) - 1)


def _item_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = texts(batch.column("text"))
        token, doc = tokens(raw, offsets)
        ends = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(token.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], ["item_id", "tokens"])


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[], [], []]
        for item, listed in zip(batch.column("item_id"), batch.column("tokens")):
            token = np.array(listed.values, np.int64).view(np.uint64)
            one = np.zeros(len(token), np.int64)
            for number, size, mask in all_masks():
                if size == size_class(len(token)):
                    at, h = seed_hashes(token, one, number, mask)
                    out[0] += h.view(np.int64).tolist()
                    out[1] += [item.as_py()] * len(at)
                    out[2] += at.tolist()
        columns = [pa.array(out[0], pa.int64()), pa.array(out[1], batch.schema.field("item_id").type), pa.array(out[2], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["h", "item_id", "item_at"])


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Which places hold a seed; at most 2 ** BITMAP_BITS bits come to the driver, 64 in a row."""
    words = 1 << (BITMAP_BITS - 6)
    high = F.shiftrightunsigned("h", 64 - BITMAP_BITS)
    low = F.shiftrightunsigned("h", 8).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    places = seeds.select(F.explode(F.array(high, low)).alias("p"))
    one = F.expr("shiftleft(1L, cast(p & 63 as int))")
    rows = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("bits")).toArrow()
    bitmap = np.zeros(words, np.int64)
    bitmap[rows.column("w").to_numpy()] = rows.column("bits").to_numpy()
    return bitmap.view(np.uint8)


def _regions(shared, margin: int, sizes: tuple[int, ...]):
    """The parts of each document that have hashes of the bitmap, with their tokens and hits."""
    masks = [(number, mask) for number, size, mask in all_masks() if size in sizes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            raw, offsets = texts(batch.column("text"))
            keys = batch.column("key")
            for a, b in chunks(offsets):
                token, doc = tokens(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
                for number, mask in masks:
                    at, h = seed_hashes(token, doc, number, mask)
                    hit = np.ones(len(at), bool)
                    for place in _bits(h):
                        hit &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    found.append((at[hit], h[hit]))
                at = np.concatenate([f[0] for f in found])
                h = np.concatenate([f[1] for f in found])
                order = np.argsort(at, kind="stable")
                at, h = at[order], h[order]
                if not len(at):
                    continue
                fresh = np.flatnonzero((np.diff(at, prepend=-(1 << 60)) > margin) | (np.diff(doc[at], prepend=-1) != 0))
                rows = {"key": [], "tokens": [], "hits": []}
                for i, j in zip(fresh, np.append(fresh[1:], len(at))):
                    own = doc[at[i]]
                    low = max(np.searchsorted(doc, own), at[i] - margin)
                    high = min(np.searchsorted(doc, own, "right"), at[j - 1] + 2 * margin)
                    rows["key"].append(a + int(own))
                    rows["tokens"].append(token[low:high].view(np.int64))
                    rows["hits"].append([{"h": x, "at": y} for x, y in zip(h[i:j].view(np.int64).tolist(), (at[i:j] - low).tolist())])
                hits = pa.array(rows["hits"], pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int64())])))
                columns = [keys.take(pa.array(rows["key"])), pa.array(rows["tokens"], pa.list_(pa.int64())), hits]
                yield pa.RecordBatch.from_arrays(columns, ["key", "tokens", "hits"])

    return run


def _verified(rule: Overlap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            equal, width, least = [], [], []
            for ours, theirs, shift in zip(batch.column("tokens"), batch.column("item_tokens"), batch.column("shift")):
                a, b, d = np.array(ours.values), np.array(theirs.values), shift.as_py()
                first, last = max(0, d), min(len(a), d + len(b))
                w = min(rule.window, last - first)
                same = np.concatenate([[0], np.cumsum(a[first:last] == b[first - d : last - d])])
                best = int((same[w:] - same[:-w]).max()) if len(same) > w else 0
                equal.append(best)
                width.append(w)
                least.append(math.ceil(rule.least_equal * min(rule.window, len(b))))
            numbers = [pa.array(column, pa.int64()) for column in (equal, width, least)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("item_id"), *numbers], ["key", "item_id", "n_equal", "n_window", "n_least"]
            )

    return run


def overlaps(docs: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap()) -> DataFrame:
    """``key``, ``item_id`` and the best overlap, for each document (``key``, ``text``) and item that share one."""
    spark = docs.sparkSession
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    key_type = docs.schema["key"].dataType.simpleString()
    items = stored(
        benchmark.select("item_id", plain("text").alias("text")).mapInArrow(_item_tokens, f"item_id {id_type}, tokens array<long>"), "bench-items"
    )
    seeds = stored(items.mapInArrow(_item_seeds, f"h long, item_id {id_type}, item_at long"), "bench-seeds")
    n = F.size("tokens")
    of_size = F.lit(0)
    for least in sorted(MASKS):
        of_size = F.when(n >= least, F.lit(least)).otherwise(of_size)
    sizes = tuple(r["size"] for r in items.select(of_size.alias("size")).distinct().collect())  # a handful
    shared = spark.sparkContext.broadcast(_bitmap(seeds))
    regions = docs.select("key", plain("text").alias("text")).mapInArrow(
        _regions(shared, rule.margin, sizes), f"key {key_type}, tokens array<long>, hits array<struct<h:bigint,at:bigint>>"
    )
    regions = stored(regions.withColumn("part", F.md5(F.to_json(F.struct("key", "tokens")))), "bench-regions")
    met = (
        regions.select("part", F.explode("hits").alias("hit"))
        .select("part", F.col("hit.h").alias("h"), F.col("hit.at").alias("at"))
        .join(seeds, "h")
        .select("part", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    sides = (
        met.join(regions.select("part", "key", "tokens").dropDuplicates(["part"]), "part")
        .join(items.select(F.col("item_id").alias("item"), F.col("tokens").alias("item_tokens")), F.col("item").eqNullSafe(F.col("item_id")))
        .select("key", "item_id", "shift", "tokens", "item_tokens")
    )
    compared = sides.mapInArrow(_verified(rule), f"key {key_type}, item_id {id_type}, n_equal long, n_window long, n_least long")
    enough = F.col("n_equal") >= F.col("n_least")
    return compared.where(enough).groupBy("key", "item_id").agg(F.max("n_equal").alias("n_equal"), F.max("n_window").alias("n_window"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap()) -> DataFrame:
    """The documents that share no passage with the benchmark, with the columns they came with."""
    key = free_name(docs, "row_key")
    own_key = F.md5(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}))
    leaks = overlaps(docs.select(own_key.alias("key"), "text"), benchmark, rule)
    found = stored(leaks.select(F.col("key").alias(key)).distinct(), "bench-leaks")
    return docs.withColumn(key, own_key).join(found, key, "left_anti").select(*docs.columns)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    return overlaps(docs, table(spark, sf_dir, "benchmark")).withColumnRenamed("key", "doc_id")
