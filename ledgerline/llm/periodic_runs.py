"""Runs: stretches of words that repeat with a period, found as maximal pairs.

A run of period q and length L makes the words from its start on agree, for exactly L - q words, with those q
words later, and neither the words before nor those after agree: a maximal pair of distance q. The other way
round, a maximal pair of distance q that agrees for at least (times - 1) * q words is a run as it stands;
nothing has to be extended. Only multiples of a period give a second pair for the same stretch, and of these
the smallest distance is kept.

The pairs come from the tree of common-prefix intervals of the sorted suffixes, walked from the leaves up. A
node has its places in order, and in one list for each word to the left. Where two children meet, each
place of the smaller asks the larger for the places within the distance that the node's depth allows, in
the lists of other left words; then it moves over. Places within such a distance lie in one arithmetic
progression, of which all but the first have the same left word, so only the lists of the two outermost
are looked at. Suffixes that share fewer words than the shortest run asks for are never put into the tree, and
documents without such suffixes are not sorted at all.

Words end at ASCII white space. Every document is treated where it is read, in chunks of documents that NumPy
sorts together; matches never cross documents, nothing is shuffled and a lost task is simply run again.

Defined results: a null, empty or blank text has no words, no runs and collapses to the empty text; a null id
stays null; repeated rows are treated row by row; an empty table gives an empty result; texts of any length
are treated whole, each by one task; other columns are left out, so they cannot clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table
from ledgerline.llm.text_arrays import IS_SPACE, chunks, mixed, texts, window_hashes, word_spans

#: A run has at least so many words, and at least so many times its period.
LEAST_WORDS = 6
LEAST_TIMES = 4
#: Bytes of texts sorted together.
CHUNK = 1 << 21
_WORD = np.random.default_rng(20250214).integers(1 << 63, size=1 << 16, dtype=np.uint64)

#: From the id and the number of words of a document to the original word at each place.
Order = Callable[[int | None, int], np.ndarray | None]


def _ranks(words: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words; equal ranks mean equal words. The last are all different."""
    n = len(words)
    _, rank = np.unique(words, return_inverse=True)
    size = np.bincount(rank)
    rank = (np.cumsum(size) - size)[rank].astype(np.int64)  # a group's rank is its first place in the order
    levels = [rank.astype(np.int32)]
    active = np.flatnonzero(size[np.searchsorted(np.cumsum(size), rank, "right")] > 1)
    width = 1
    while len(active):
        after = active + width
        key = rank[active] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key)
        active, key = active[order], key[order]
        group = rank[active]
        new = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(new)
        old = np.append(True, group[1:] != group[:-1])
        at = np.arange(len(active))
        inside = at - np.maximum.accumulate(np.where(old, at, 0))
        start = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = group + inside[start]
        levels.append(rank.astype(np.int32))
        active = active[np.repeat(np.diff(np.append(first, len(active))) > 1, np.diff(np.append(first, len(active))))]
        width *= 2
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words suffixes share."""
    n = len(levels[0])
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = np.flatnonzero(np.maximum(x, y) < n)
        same = levels[k][x[inside]] == levels[k][y[inside]]
        shared[inside[same]] += 1 << k
    return shared


class _Node:
    """Places of an interval in order, and by the word to their left."""

    __slots__ = ("depth", "places", "by_left")

    def __init__(self, place: int, left: int):
        self.depth = 0
        self.places = [place]
        self.by_left = {left: [place]}


def _joined(a: _Node, b: _Node, depth: int, left: list[int], times: int, found: list[tuple[int, int, int]]) -> _Node:
    """The children put together, after noting the maximal pairs between them as (start, distance, shared words)."""
    if len(a.places) < len(b.places):
        a, b = b, a
    reach = depth // (times - 1)
    places, by_left = a.places, a.by_left
    for p in b.places:
        lo, hi = bisect_left(places, p - reach), bisect_right(places, p + reach)
        if lo < hi:
            own = left[p]
            for other in {left[places[lo]], left[places[hi - 1]]}:
                if other != own:
                    there = by_left[other]
                    for q in there[bisect_left(there, p - reach) : bisect_right(there, p + reach)]:
                        found.append((p, q - p, depth) if p < q else (q, p - q, depth))
    for p in b.places:
        insort(places, p)
    for word, there in b.by_left.items():
        mine = by_left.setdefault(word, there)
        if mine is not there:
            for p in there:
                insort(mine, p)
    return a


def _pairs(suffixes: list[int], shared: list[int], left: list[int], times: int) -> list[tuple[int, int, int]]:
    """The maximal pairs of suffixes in order; ``shared`` has the words each shares with the next, 0 at the end of a tree."""
    found: list[tuple[int, int, int]] = []
    stack: list[_Node] = []
    for place, depth in zip(suffixes, shared):
        node = _Node(place, left[place])
        while stack and stack[-1].depth > depth:
            top = stack.pop()
            node = _joined(top, node, top.depth, left, times, found)
        if stack and stack[-1].depth == depth:
            top = stack.pop()
            node = _joined(top, node, depth, left, times, found)
        if depth:
            node.depth = depth
            stack.append(node)
    return found


def runs_of(words: np.ndarray, edges: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> np.ndarray:
    """All runs of texts whose words are numbers, as rows (text, start, length, period) in that order.

    ``edges`` says where each text's words begin, with the end. Starts count from the text's first word.
    """
    if times < 4:
        raise ValueError("places within reach lie in one progression only for runs of four times their period or more")
    # A run shares (times - 1) * q words with itself q later, and least - q where that is more.
    few = min(max(least - q, (times - 1) * q) for q in range(1, least + 1))
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    # Texts in which no window of that many words has a hash twice have no run.
    windows = window_hashes(mixed(words.astype(np.uint64) + _WORD[0]), few)
    at = np.flatnonzero(np.arange(len(windows)) + few <= edges[text[: len(windows)] + 1])
    key = windows[at] ^ mixed(text[at].astype(np.uint64) + _WORD[1])
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    slot = np.minimum(np.searchsorted(twice, key), max(len(twice) - 1, 0))
    chosen = np.unique(text[at[twice[slot] == key]]) if len(twice) else np.zeros(0, np.int64)
    if not len(chosen):
        return np.zeros((0, 4), np.int64)
    place = np.flatnonzero(np.isin(text, chosen))
    own = text[place]
    _, part = np.unique(words[place], return_inverse=True)
    levels = _ranks(own * (part.max() + 1) + part)  # words of different texts differ, so no match crosses
    suffixes = np.argsort(levels[-1], kind="stable")
    shared = np.zeros(len(suffixes), np.int64)
    narrow = levels[min(few.bit_length(), len(levels)) - 1]
    close = np.flatnonzero(narrow[suffixes[1:]] == narrow[suffixes[:-1]])
    shared[close] = _common(levels, suffixes[close], suffixes[close + 1])
    shared[shared < few] = 0
    within = (shared > 0) | np.append(False, shared[:-1] > 0)
    first = np.append(True, own[1:] != own[:-1])
    left = np.where(first, -1, np.append(-1, part[:-1]))
    found = np.array(_pairs(suffixes[within].tolist(), shared[within].tolist(), left.tolist(), times), np.int64).reshape(-1, 3)
    start, period, common = found.T
    length = common + period
    enough = (length >= least) & (length >= times * period)
    start, length, period = start[enough], length[enough], period[enough]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[fresh], length[fresh], period[fresh]
    order = np.lexsort((period, start))
    out = np.column_stack([own[start], place[start], length, period])[order]
    out[:, 1] -= edges[out[:, 0]]
    return out


def _words(part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The number of every word, where each text's words begin, and the words by number."""
    starts, stops, text = word_spans(part, offsets)
    edges = np.searchsorted(text, np.arange(len(offsets)))
    if not len(starts):
        return starts, edges, []
    solid = np.ascontiguousarray(part[~IS_SPACE[part]])
    bounds = np.append(0, np.cumsum(stops - starts)).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(solid)])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), edges, coded.dictionary.to_pylist()


def _treated(part: np.ndarray, offsets: np.ndarray, ids: pa.Array, order: Order | None, least: int, times: int) -> pa.RecordBatch:
    words, edges, of = _words(part, offsets)
    if order is not None:
        for i, doc_id in enumerate(ids.to_pylist()):
            a, b = edges[i], edges[i + 1]
            places = order(doc_id, int(b - a))
            if places is not None:
                words[a:b] = words[a:b][places]
    runs = runs_of(words, edges, least, times)
    cover = np.zeros(len(words) + 1, np.int64)
    begin = edges[runs[:, 0]] + runs[:, 1]
    np.add.at(cover, begin + runs[:, 3], 1)
    np.add.at(cover, begin + runs[:, 2], -1)
    kept = np.cumsum(cover)[:-1] == 0
    places = np.flatnonzero(kept)
    kept_edges = np.searchsorted(places, edges).tolist()
    spelled = list(map(of.__getitem__, words[places].tolist()))
    collapsed = [b" ".join(spelled[a:b]) for a, b in zip(kept_edges[:-1], kept_edges[1:])]
    run = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
    run_edges = np.searchsorted(runs[:, 0], np.arange(len(edges))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(edges)), pa.ListArray.from_arrays(pa.array(run_edges), run), pa.array(collapsed, pa.binary()).cast(pa.string())],
        ["doc_id", "n_words", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES, order: Order | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, all ``runs`` by start and period, and the ``collapsed`` text of every document.

    A run has at least ``least`` words and ``times`` its period. The collapsed text leaves out the words that
    some run holds after its first period, and joins the others by one blank. ``order`` may put other words
    of a document in place of its own before runs are looked for.
    """
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = texts(batch.column("text"))
            for a, b in chunks(offsets, CHUNK):
                own = offsets[a : b + 1] - offsets[a]
                yield _treated(raw[offsets[a] : offsets[b]], own, batch.column("doc_id").slice(a, b - a), order, least, times)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The query's own repetitions: one in ten documents, by the checksum of its id, repeats words from a place on."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs(table(spark, sf_dir, "documents"), order=planted)
    # Runs come by start and period, so the first of the greatest ratio has the smallest.
    best = F.reduce(
        "runs", F.get("runs", F.lit(0)), lambda x, r: F.when(r.length * x.period > x.length * r.period, r).otherwise(x)
    )
    line = lambda r: F.concat_ws(",", r.start, r.length, r.period)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )
