"""Spelling variants: words one edit apart, found by dense comparison of tiles.

Two words are one insertion, deletion or replacement apart if what they share at the front and what they
share at the back reach the longer one's length less one. A tile is a block of words as matrices of code
points, padded behind for the fronts and before for the backs; two blocks are compared in all places at once,
column by column.

One of the two shared parts has at least half of that length. So words meet in a tile only with those that
have the same first half, or the same last half, as some word of their length or one more: each word is in
four tiles' groups, and a pair is taken in the group of the front, or of the back if the front is too
short. Small groups are compared together in one block; groups beyond a block are cut into slices, and each
pair of slices is a tile of its own, dealt to any task. So a half that a third of all words share is spread out,
and no pair is lost.

Words are counted in the task that reads them and summed by a shuffle. The most frequent near word becomes a
word's form if it is frequent enough; a form is some times as frequent, so chains are short, and
their ends are found by doubling steps, written to the shared folder.

Defined results: a null or empty text has no words; repeated rows count row by row; of near words with equal
counts the smallest in code-point order is the form; an empty table gives an empty result; runs of letters of any
length are one word; other columns are left out, so they cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, table
from ledgerline.llm.text_arrays import chunks, texts

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: How many times as frequent as a word its form is.
TIMES = 5
#: Words compared with each other at once, and code points of them; words of a slice of a large group.
BLOCK = 512
BLOCK_POINTS = 1 << 22
SLICE = 4096
#: Distinct words whose counts a task holds before it hands them on.
HELD = 400_000
CHUNK = 1 << 21

#: From the ids and the words (UTF-8), one for each pair of a document and a distinct word of it, whether the word is
#: spelled otherwise there, and how.
Respelled = Callable[[list, list[bytes]], list[bytes | None]]

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True  # 0xC3 leads U+00C0 to U+00FF
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of letters."""
    inside = _LETTER[raw]
    inside[1:] |= raw[:-1] == 0xC3
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.append(False, inside[:-1]) & ~edge[:-1]
    after = np.append(inside[1:], False) & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(offsets, starts, "right") - 1


def _points(words: list[bytes]) -> np.ndarray:
    """How many code points each word has."""
    return np.fromiter((len(w) - w.count(b"\xc3") for w in words), np.int64, len(words))


def _chunk_counts(raw: np.ndarray, offsets: np.ndarray, ids: list, respelled: Respelled | None) -> tuple[list[bytes], np.ndarray]:
    """The words of a chunk of texts, some perhaps twice, and their counts."""
    raw = _LOWER[raw]
    starts, stops, text = _runs(raw, offsets)
    if not len(starts):
        return [], np.zeros(0, np.int64)
    cover = np.zeros(len(raw) + 1, np.int8)
    cover[starts] += 1
    cover[stops] -= 1
    solid = np.ascontiguousarray(raw[np.cumsum(cover[:-1], dtype=np.int8) > 0])
    bounds = np.append(0, np.cumsum(stops - starts)).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(solid)])
    coded = column.dictionary_encode()
    words, number = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    counts = np.bincount(number, minlength=len(words))
    if respelled is None:
        return words, counts
    pair, times = np.unique(text * len(words) + number, return_counts=True)
    owner, word = np.divmod(pair, len(words))
    instead = respelled(list(map(ids.__getitem__, owner.tolist())), list(map(words.__getitem__, word.tolist())))
    changed = np.flatnonzero(np.fromiter((w is not None for w in instead), bool, len(instead)))
    np.subtract.at(counts, word[changed], times[changed])
    return words + [instead[i] for i in changed.tolist()], np.append(counts, times[changed])


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, respelled: Respelled | None = None) -> DataFrame:
    """``word`` and ``n``, how often it occurs: runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased,
    of at least ``least_length`` code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            raw, offsets = texts(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for a, b in chunks(offsets, CHUNK):
                words, counts = _chunk_counts(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ids[a:b], respelled)
                enough = ((_points(words) >= least_length) & (counts > 0)).tolist()
                for word, n in zip(compress(words, enough), compress(counts.tolist(), enough)):
                    held[word] += n
                if len(held) >= HELD:
                    yield rows()
                    held.clear()
        yield rows()

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, padded behind and padded before, as bytes where they fit; one row a place."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    flat = flat.astype(np.uint8 if len(flat) and flat.max() < 256 else np.uint32)
    row = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    front = np.zeros((width, len(words)), flat.dtype)
    back = np.zeros((width, len(words)), flat.dtype)
    front[place, row] = flat
    back[place + np.repeat(width - size, size), row] = flat
    return front, back[::-1]


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many places from the first on the columns of one matrix share with those of the other.

    Padding never meets padding before a difference, as one word of each pair that matters has no padding and the others
    end at different places only where they differ.
    """
    running = np.ones((a.shape[1], b.shape[1]), bool)
    shared = np.zeros(running.shape, np.uint8 if len(a) < 256 else np.int32)
    for x, y in zip(a, b):
        running &= x[:, None] == y[None, :]
        if not running.any():
            break
        shared += running
    return shared


def half(longer: int) -> int:
    """What words one edit apart, the longer one of this length, share at least at the front or at the back."""
    return longer // 2


def near_in_tile(left: list[str], right: list[str], longer: int, at_back: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``left`` and ``right`` of words one edit apart, the longer of the given length.

    Those that share half at the front, or those that share half at the back and not at the front.
    """
    (front_a, back_a), (front_b, back_b) = _matrices(left, longer), _matrices(right, longer)
    found = []
    for at in range(0, len(left), BLOCK):
        cut = slice(at, at + BLOCK)
        fronts = _shared(front_a[:, cut], front_b)
        backs = _shared(back_a[:, cut], back_b)
        near = (fronts >= half(longer)) != at_back
        near &= fronts.astype(np.int32) + backs >= longer - 1
        i, j = np.nonzero(near)
        found.append((i + at, j))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of rows that come sorted by tile."""
    kind, words, counts, slices = None, [], [], []

    def compared() -> pa.RecordBatch:
        longer, at_back, _, first, second, cut = kind
        if cut and first != second:
            a = [i for i, s in enumerate(slices) if s == first]
            b = [i for i, s in enumerate(slices) if s == second]
        else:
            a = b = list(range(len(words)))
        i, j = near_in_tile([words[x] for x in a], [words[x] for x in b], longer, bool(at_back))
        i, j = np.array(a, np.int64)[i], np.array(b, np.int64)[j]
        once = np.ones(len(i), bool) if cut and first != second else i < j
        i, j = i[once], j[once]
        both, other = np.append(i, j), np.append(j, i)
        spelled, n = pa.array(words, pa.string()), pa.array(counts, pa.int64())
        columns = [spelled.take(pa.array(both)), n.take(pa.array(both)), spelled.take(pa.array(other)), n.take(pa.array(other))]
        return pa.RecordBatch.from_arrays(columns, ["word", "n", "other", "other_n"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("longer", "at_back", "half", "first", "second", "cut", "slice", "word", "n")]
        for longer, at_back, key, first, second, cut, own, word, n in zip(*columns):
            tile = (longer, at_back, key, first, second, cut)
            # Groups that are not cut lie together in a block; the sums of shared parts keep their words apart.
            if kind is not None and tile != kind:
                alone = cut or kind[5] or tile[:2] != kind[:2]
                if alone or len(words) >= BLOCK or len(words) * longer >= BLOCK_POINTS:
                    yield compared()
                    words, counts, slices = [], [], []
            kind = tile
            words.append(word)
            counts.append(n)
            slices.append(own)
    if words:
        yield compared()


def near_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``other`` and ``other_n`` of all words one edit apart, both ways round.

    ``words`` has distinct words and their counts ``n``.
    """
    size = F.length("word")
    longer = F.explode(F.array(size, size + 1))
    rows = words.select("word", "n", longer.alias("longer")).select("*", F.floor(F.col("longer") / 2).cast("int").alias("h"))
    halves = F.array(
        F.struct(F.lit(0).alias("at_back"), F.xxhash64(F.expr("left(word, h)")).alias("half")),
        F.struct(F.lit(1).alias("at_back"), F.xxhash64(F.expr("right(word, h)")).alias("half")),
    )
    rows = stored(rows.select("word", "n", "longer", F.explode(halves).alias("g")).select("word", "n", "longer", "g.*"), "spelling-halves")
    group = ["longer", "at_back", "half"]
    large = (
        rows.groupBy(*group)
        .agg(F.count("*").alias("many"), F.sum(F.length("word").cast("long")).alias("points"))
        .select(*group, F.greatest(F.ceil(F.col("many") / SLICE), F.ceil(F.col("points") / BLOCK_POINTS)).cast("int").alias("slices"))
        .where("slices > 1")
    )
    # The few large groups are looked up by all rows; their table has at most one row for each ``SLICE`` words.
    sliced = rows.join(stored(large, "spelling-large"), group, "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    sliced = sliced.withColumn("slice", F.pmod(F.xxhash64("word", F.lit(7)), F.col("slices")).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("partner")
    dealt = sliced.select("*", partner).select(
        "word", "n", *group, "slice", (F.col("slices") > 1).alias("cut"),
        F.least("slice", "partner").alias("first"), F.greatest("slice", "partner").alias("second"),
    )
    tile = [*group, "first", "second"]
    return (
        dealt.repartition(*tile).sortWithinPartitions(*tile)
        .mapInArrow(_tiles, "word string, n long, other string, other_n long")
    )


def with_roots(words: DataFrame) -> DataFrame:
    """Adds ``root``, the end of the chain of forms that begins at a word."""
    steps = stored(words.where("form is not null").select(F.col("word").alias("from"), F.col("form").alias("to")), "spelling-steps")
    while True:
        # Each round doubles the length of the steps, and chains are short: every form is some times as frequent.
        next_steps = steps.select(F.col("from").alias("to"), F.col("to").alias("next"))
        longer = steps.join(next_steps, "to", "left").select("from", F.coalesce("next", "to").alias("to"), "next")
        longer = stored(longer, "spelling-steps")
        steps = longer.select("from", "to")
        if longer.where("next is not null").isEmpty():
            break
    ends = steps.select(F.col("from").alias("word"), F.col("to").alias("root"))
    return words.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of a table of distinct words."""
    words = stored(words.select("word", "n"), "spelling-words")
    near = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("o"))).alias("top")
    )
    joined = words.join(near, "word", "left")
    often = -F.col("top.less") >= F.lit(times) * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(often, F.col("top.o")).alias("form"), F.when(often, -F.col("top.less")).alias("form_n"),
    )
    return with_roots(stored(formed, "spelling-forms"))


def planted(ids: list, words: list[bytes]) -> list[bytes | None]:
    """The query's own misspellings: one in 199 words of a document, by a checksum, lacks a code point."""
    prefix: dict = {}
    out: list[bytes | None] = [None] * len(words)
    for i, (doc_id, word) in enumerate(zip(ids, words)):
        begun = prefix.get(doc_id)
        if begun is None:
            if doc_id is None:
                continue
            begun = prefix[doc_id] = zlib.crc32(f"{doc_id}:".encode())
        h = zlib.crc32(word, begun)
        if h % 199 == 0:
            spelled = word.decode()
            at = h % len(spelled)
            out[i] = (spelled[:at] + spelled[at + 1 :]).encode()
    return out


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = word_counts(table(spark, sf_dir, "documents"), LEAST_LENGTH, planted)
    found = variants(counted.where(F.col("n") >= LEAST_COUNT))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
