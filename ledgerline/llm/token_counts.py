"""Token counts by distinct pre-tokens.

A text's tokens are the sum, over its pre-tokens, of how often each occurs times its number of pieces.
The pieces of every distinct pre-token are counted once, and joined to the frequencies in each document;
no ids are kept. Pre-tokens end at ASCII white space, and between ASCII letters or digits and other ASCII
characters; the tokenizer never joins across such a border. Apostrophes (contractions) and words that may
hold a special token's string are not parted.

The most frequent pre-tokens, at most ``head`` of them, make up most of any corpus and would be hot keys
of a join. Their counts are a table of bounded size that goes to every task, which sums them on the spot;
all others are joined by a shuffle, whatever their number.

Defined results: a null text is empty and has no bytes and no tokens; repeated rows are counted row by
row; an empty table gives an empty result; texts are never cut.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, table
from ledgerline.llm.text_arrays import IS_SPACE, byte_hashes, chunks, texts, word_spans

HEAD = 200_000
LIMIT = 2048
#: Longest pre-token in the table that goes to every task; with ``HEAD`` it bounds the table's size.
HEAD_BYTES = 64

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not _ALNUM[b] and b != ord("'")]] = True


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pieces(path: str, pretokens: list[str]) -> list[int]:
    encoded = _tokenizer(path).encode_batch_fast(pretokens, add_special_tokens=False)
    return [len(e.ids) for e in encoded]


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every pre-token."""
    starts, stops, doc = word_spans(raw, offsets)
    if not len(starts):
        return starts, stops, doc
    alnum, mark = _ALNUM[raw], _PUNCTUATION[raw]
    border = np.flatnonzero((alnum[:-1] & mark[1:]) | (mark[:-1] & alnum[1:])) + 1
    word = np.searchsorted(starts, border, "right") - 1
    border = border[(word >= 0) & (border > starts[word]) & (border < stops[word])]
    special = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
    if len(special):
        word = np.searchsorted(starts, border, "right") - 1
        kept_whole = np.searchsorted(starts, special, "right") - 1
        border = border[~np.isin(word, kept_whole)]
    both = np.sort(np.concatenate([starts, border]))
    last = np.sort(np.concatenate([stops, border]))
    return both, last, np.searchsorted(offsets, both, "right") - 1


def _distinct(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct pre-tokens of a chunk, and the number of each pre-token's."""
    first, again = byte_hashes(raw, starts, stops, 0), byte_hashes(raw, starts, stops, 1)
    both = first ^ (again << np.uint64(1)) if len(first) else first
    _, at, inverse = np.unique(both, return_index=True, return_inverse=True)
    data = raw.tobytes()
    return [data[a:b] for a, b in zip(starts[at].tolist(), stops[at].tolist())], inverse


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[bytes] = Counter()
    size = 0

    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        raw, offsets = texts(batch.column("text"))
        for a, b in chunks(offsets):
            part = raw[offsets[a] : offsets[b]]
            starts, stops, _ = spans(part, offsets[a : b + 1] - offsets[a])
            found, inverse = _distinct(part, starts, stops)
            for word, n in zip(found, np.bincount(inverse, minlength=len(found)).tolist()):
                total[word] += n
                size += 0 if n != total[word] else len(word) + 100
            if size > 1 << 26:  # emitted early, so that the counter stays bounded
                yield rows()
                total.clear()
                size = 0
    yield rows()


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").cast(pa.string()).to_pylist()
            out = [pa.array(pieces(path, words), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *out], ["word", "n", "pieces"])

    return run


def _summed(known: dict[bytes, int]):
    """Bytes, tokens of known pre-tokens, and the other pre-tokens with their frequencies, by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = texts(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in chunks(offsets):
                part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                starts, stops, doc = spans(part, at)
                found, inverse = _distinct(part, starts, stops)
                counts = np.array([known.get(w, -1) for w in found], np.int64)
                of_each = counts[inverse] if len(inverse) else np.zeros(0, np.int64)
                head = np.bincount(doc, np.maximum(of_each, 0), b - a).astype(np.int64)
                rare = of_each < 0
                pair, n = np.unique(doc[rare] * max(len(found), 1) + inverse[rare], return_counts=True)
                owner, word = np.divmod(pair, max(len(found), 1))
                ends = np.searchsorted(owner, np.arange(b - a + 1))
                words = pa.array(found, pa.binary()).take(pa.array(word))
                items = pa.StructArray.from_arrays([words, pa.array(n.astype(np.int64))], ["word", "freq"])
                rest = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(np.diff(at)), pa.array(head), rest],
                    ["doc_id", "n_bytes", "head", "rest"],
                )

    return run


def token_counts(docs: DataFrame, path: str, head: int = HEAD) -> DataFrame:
    """One row per document: its id, its bytes, and its tokens by the tokenizer file at ``path``."""
    spark = docs.sparkSession
    light = docs.select("doc_id", "text")
    frequencies = (
        light.select("text")
        .mapInArrow(_frequencies, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    counted = stored(frequencies.mapInArrow(_counted(path), "word binary, n long, pieces long"), "token-pieces")
    frequent = counted.where(F.octet_length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "word").limit(head)
    top = frequent.select("word", "pieces").toArrow()  # at most ``head`` short rows
    known = dict(zip(top.column("word").to_pylist(), top.column("pieces").to_pylist()))
    shared = spark.sparkContext.broadcast(known)

    def run(batches):
        yield from _summed(shared.value)(batches)

    sums = light.mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, head long, "
        "rest array<struct<word:binary,freq:bigint>>"
    )
    sums = stored(sums, "token-sums").withColumn("row", F.monotonically_increasing_id())
    sums = stored(sums, "token-rows")
    tail = sums.where(F.size("rest") > 0).select("row", F.explode("rest").alias("r"))
    tail = (
        tail.select("row", F.col("r.word").alias("word"), F.col("r.freq").alias("freq"))
        .join(counted.select("word", "pieces"), "word")
        .groupBy("row")
        .agg(F.sum(F.col("freq") * F.col("pieces")).alias("tail"))
    )
    return sums.drop("rest").join(tail, "row", "left").select(
        "doc_id", "n_bytes", (F.col("head") + F.coalesce("tail", F.lit(0))).alias("n_tokens")
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
