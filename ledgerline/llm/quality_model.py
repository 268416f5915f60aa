"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal updates.

A text's features are its tokens and pairs of neighbouring tokens, hashed into buckets; a token is a
run of letters, digits and non-ASCII characters, or one other character. A token that comes again at once
or after one other also counts as a repeat, whichever token it is. A feature's value is its share
of the text's features. Training follows the regularised leader: every coordinate keeps the sum of its
adjusted gradients and of their squares, from which its weight follows in closed form, with exact zeros
by the l1 term. Scores are sparse dot products through the logistic function.

The model is fitted on at most ``max_labels`` labelled documents, the first by hash, in a fixed order.
Every document is scored, over its whole text.

Defined results: a null text is empty, and an empty text scores the model's bias; rows with a null id
count as held out; repeated rows get equal scores; without labelled rows every score is one half; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, table
from ledgerline.llm.text_arrays import IS_SPACE, byte_hashes, chunks, mixed, texts

THRESHOLD = 0.3
FOLDS = 5


@dataclass(frozen=True)
class Ftrl:
    bits: int = 18
    alpha: float = 0.6
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 0.02
    epochs: int = 3
    scale: float = 60.0
    max_labels: int = 5_000


_KIND = np.zeros(256, np.uint8)  # 0: white space, 1: part of a run, 2: a token of its own
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[(_KIND == 0) & ~IS_SPACE] = 2


def features(raw: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every token and pair of neighbours, by text."""
    kind = _KIND[raw]
    new = np.ones(len(raw), bool)
    if len(raw):
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        edges = offsets[:-1]
        new[edges[edges < len(raw)]] = True
    cuts = np.append(np.flatnonzero(new), len(raw))
    starts, stops = cuts[:-1], cuts[1:]
    token = kind[starts] > 0
    starts, stops = starts[token], stops[token]
    doc = np.searchsorted(offsets, starts, "right") - 1
    single = byte_hashes(raw, starts, stops)
    shift = np.uint64(64 - bits)
    pair = mixed(single[:-1] * np.uint64(0x9E3779B97F4A7C15) + single[1:]) >> shift
    same = doc[:-1] == doc[1:]
    # Pairs of equal tokens share a bucket, next to each other or with one token between.
    pair[single[:-1] == single[1:]] = 0
    again = (single[:-2] == single[2:]) & (doc[:-2] == doc[2:])
    bucket = np.concatenate([single >> shift, pair[same], np.ones(again.sum(), np.uint64)]).astype(np.int64)
    return bucket, np.concatenate([doc, doc[1:][same], doc[2:][again]])


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], settings: Ftrl) -> np.ndarray:
    """The weights, with the bias last, from (buckets, shares, label) in the given order."""
    n = 1 << settings.bits
    z, squares = np.zeros(n + 1), np.zeros(n + 1)

    def weights(at):
        part = z[at]
        shrunk = np.sign(part) * settings.l1 - part
        w = shrunk / ((settings.beta + np.sqrt(squares[at])) / settings.alpha + settings.l2)
        return np.where(np.abs(part) <= settings.l1, 0.0, w)

    order = np.random.default_rng(3)
    for _ in range(settings.epochs):
        for i in order.permutation(len(examples)):
            buckets, shares, label = examples[i]
            at, x = np.append(buckets, n), np.append(settings.scale * shares, 1.0)
            w = weights(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            sigma = (np.sqrt(squares[at] + gradient**2) - np.sqrt(squares[at])) / settings.alpha
            z[at] += gradient - sigma * w
            squares[at] += gradient**2
    return weights(np.arange(n + 1)).astype(np.float32)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def _example_rows(bits: int):
    """Buckets and shares of each labelled document, all of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = texts(batch.column("text"))
            buckets, shares = [], []
            for i in range(batch.num_rows):
                part = raw[offsets[i] : offsets[i + 1]]
                found, n = np.unique(features(part, np.array([0, len(part)]), bits)[0], return_counts=True)
                buckets.append(found.astype(np.int32))
                shares.append((n / max(1, n.sum())).astype(np.float32))
            columns = [
                batch.column("rank"),
                batch.column("label"),
                pa.array(buckets, pa.list_(pa.int32())),
                pa.array(shares, pa.list_(pa.float32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["rank", "label", "buckets", "shares"])

    return run


def fit(docs: DataFrame, labelled: DataFrame, settings: Ftrl = Ftrl()) -> np.ndarray:
    """Weights from ``labelled`` (doc_id, label), of which at most ``max_labels`` rows are used."""
    chosen = labelled.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    rank = F.xxhash64("doc_id")
    chosen = stored(
        chosen.select("doc_id", "label", rank.alias("rank")).orderBy("rank", "doc_id").limit(settings.max_labels),
        "quality-sample",
    )
    # The sample is bounded by ``max_labels`` rows of three numbers.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("rank", "label", "text")
    # A label belongs to one text: of rows with equal ids the first by hash is taken.
    rows = sample.mapInArrow(
        _example_rows(settings.bits), "rank long, label int, buckets array<int>, shares array<float>"
    ).toArrow()
    examples: dict[int, tuple] = {}
    for r, label, b, s in zip(*(rows.column(c) for c in ("rank", "label", "buckets", "shares"))):
        example = (np.array(b.values, np.int64), np.array(s.values, np.float64), label.as_py())
        if r.as_py() not in examples or len(example[0]) > len(examples[r.as_py()][0]):
            examples[r.as_py()] = example
    return train([examples[r] for r in sorted(examples)], settings)


def scores(docs: DataFrame, model: np.ndarray, settings: Ftrl = Ftrl()) -> DataFrame:
    """``doc_id`` and ``score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    n, bits, scale = 1 << settings.bits, settings.bits, settings.scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            raw, offsets = texts(batch.column("text"))
            total = np.zeros(batch.num_rows)
            for a, b in chunks(offsets):
                at = offsets[a : b + 1] - offsets[a]
                buckets, doc = features(raw[offsets[a] : offsets[b]], at, bits)
                size = np.maximum(np.bincount(doc, minlength=b - a), 1)
                total[a:b] = scale * np.bincount(doc, weights[buckets], b - a) / size
            score = 1 / (1 + np.exp(-np.clip(total + weights[n], -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double"
    )


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Ftrl = Ftrl()) -> DataFrame:
    """One row per document; labels of the held-out fifth are not used."""
    labelled = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(fold(F.col("doc_id")) != 0)
    scored = scores(docs, fit(docs, labelled, settings), settings)
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
