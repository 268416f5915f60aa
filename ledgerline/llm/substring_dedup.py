"""Repeated passages by fixed-block anchors.

Each document is indexed by its non-overlapping blocks of ``anchor`` words and probed with every rolling
window of as many words. A repeated passage of ``window`` = 2 * ``anchor`` words, or more, holds a whole
indexed block wherever it begins, so its other copies are hit by a probe. Around the hits, the windows of
``window`` words are compared, by 96 bits of hash, to find which began earlier elsewhere; windows side by
side join to the maximal repeats, whose words are removed.

Index and probes meet by key ranges, in the packed cells of :mod:`ledgerline.llm.blocks`: a key that a
third of all documents share is one entry per block of documents.

A window began earlier if its words also start in a document with a smaller id, or earlier in the same
document. All windows are judged on the input. Defined results: a null text has no words; a null id comes
after all others; rows with equal ids are neither before each other; very long texts are treated whole; other columns are
left out; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.blocks import (
    REPLY,
    answered,
    bits_of,
    cell_edges,
    groups_of,
    in_blocks,
    joined,
    ordered,
)
from ledgerline.llm.common import table
from ledgerline.llm.text_arrays import byte_hashes, chunks, texts, window_hashes, word_spans

ANCHOR = 10

_PROBES = "bucket long, block long, high binary, low binary, flags binary"
_WINDOWS = "bucket long, block long, kind int, k1 binary, k2 binary, ids binary"


def _words(block: pa.Table, variants: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes and row number of every word of a block."""
    raw, offsets = texts(block.column("text"))
    hashes, rows = [[] for _ in range(variants)], []
    for a, b in chunks(offsets, 1 << 21):
        part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, stops, doc = word_spans(part, at)
        for v in range(variants):
            hashes[v].append(byte_hashes(part, starts, stops, v))
        rows.append(doc + a)
    empty = [np.zeros(0, np.uint64)]
    return [np.concatenate(h or empty) for h in hashes], np.concatenate(rows or [np.zeros(0, np.int64)])


def _anchors(word: np.ndarray, row: np.ndarray, anchor: int):
    """Place, 48-bit key and whether it is indexed, of each rolling window that lies in one document."""
    key = window_hashes(word, anchor) & ~np.uint64(0xFFFF)
    at = np.flatnonzero(row[: len(key)] == row[anchor - 1 :]) if len(key) else np.zeros(0, np.int64)
    within = at - np.searchsorted(row, row[at])
    return at, key[at], within % anchor == 0


def _ask_probes(n: int, anchor: int):
    def run(block: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        block, _ = ordered(block)
        (word,), row = _words(block, 1)
        _, key, indexed = _anchors(word, row, anchor)
        order, first = groups_of(key)
        rows = {c: [] for c in ("bucket", "block", "high", "low", "flags")}
        if len(first):
            distinct = key[order][first]
            many = np.diff(np.append(first, len(key))) > 1
            flags = (np.maximum.reduceat(indexed[order], first) + 2 * many).astype(np.uint8)
            buckets, edges = cell_edges(distinct, n)
            high = (distinct >> np.uint64(48)).astype(np.uint16)
            low = (distinct >> np.uint64(16)).astype(np.uint32)
            for bucket, a, b in zip(buckets.tolist(), edges[:-1], edges[1:]):
                for c, v in zip(rows, (bucket, number, high[a:b].tobytes(), low[a:b].tobytes(), flags[a:b].tobytes())):
                    rows[c].append(v)
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

    return run


def _answer_probes(cells: pa.Table) -> list[np.ndarray]:
    """A key is hit if it is indexed somewhere and occurs at another place too."""
    high, edges = joined(cells.column("high"), np.uint16)
    low, _ = joined(cells.column("low"), np.uint32)
    flags, _ = joined(cells.column("flags"), np.uint8)
    key = (high.astype(np.uint64) << np.uint64(32)) | low
    order, first = groups_of(key)
    hit = np.zeros(len(key), bool)
    if len(first):
        sizes = np.diff(np.append(first, len(key)))
        any_flag = np.bitwise_or.reduceat(flags[order], first)
        found = ((any_flag & 1) > 0) & ((sizes > 1) | ((any_flag & 2) > 0))
        hit[order] = np.repeat(found, sizes)
    return [hit[a:b] for a, b in zip(edges[:-1], edges[1:])]


def _window_groups(block: pa.Table, candidate: np.ndarray, width: int):
    """The candidate windows' places, keys, order and groups."""
    (first, second), row = _words(block, 2)
    at = np.flatnonzero(candidate)
    k1 = window_hashes(first, width, 0)[at]
    k2 = (window_hashes(second, width, 1)[at] >> np.uint64(32)).astype(np.uint32)
    order, start = groups_of(k1, k2)
    return row, at, k1, k2, order, start


def _ask_windows(n: int, anchor: int):
    width = 2 * anchor

    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        out = {c: [] for c in ("bucket", "block", "kind", "k1", "k2", "ids")}
        if len(block):
            number = block.column("block")[0].as_py()
            block, ids = ordered(block)
            (word,), row = _words(block, 1)
            at, key, _ = _anchors(word, row, anchor)
            order, first = groups_of(key)
            hit = np.zeros(len(word) + 1, np.int64)
            if len(first):
                bits = bits_of(replies, key[order][first], n)
                hit[at[order] + 1] = np.repeat(bits, np.diff(np.append(first, len(key))))
            hits = np.cumsum(hit)
            # A window is a candidate if one of the anchors inside it is hit.
            last = max(0, len(word) - width + 1)
            inside = row[:last] == row[len(row) - last :] if last else np.zeros(0, bool)
            candidate = inside & (hits[width - anchor + 1 :][:last] > hits[:last])
            if candidate.any():
                _, at, k1, k2, order, start = _window_groups(block, candidate, width)
                lead = order[start]  # the first of each group in the block's order, so with the least id
                k1, k2, own = k1[lead], k2[lead], ids[row[at[lead]]]
                buckets, edges = cell_edges(k1, n)
                cells = [(int(c), 0, k1[a:b], k2[a:b], own[a:b]) for c, a, b in zip(buckets, edges[:-1], edges[1:])]
                # The candidates themselves come back as they are.
                cells.append((number % n, 1, np.packbits(candidate), np.zeros(0), np.zeros(0)))
                for bucket, kind, *arrays in cells:
                    for c, v in zip(out, (bucket, number, kind, *(x.tobytes() for x in arrays))):
                        out[c].append(v)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

    return run


def _answer_windows(cells: pa.Table) -> pa.Table:
    """Whether a window also starts in a document with a smaller id than the least of the asking block."""
    asked = cells.filter(pc.equal(cells.column("kind"), 0))
    k1, edges = joined(asked.column("k1"), np.uint64)
    k2, _ = joined(asked.column("k2"), np.uint32)
    ids, _ = joined(asked.column("ids"), np.int64)
    order, first = groups_of(k1, k2)
    earlier = np.zeros(len(k1), bool)
    if len(first):
        least = np.minimum.reduceat(ids[order], first)
        earlier[order] = np.repeat(least, np.diff(np.append(first, len(k1)))) < ids[order]
    bits = [np.packbits(earlier[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:])]
    back = cells.filter(pc.equal(cells.column("kind"), 1))
    columns = [pa.concat_arrays([*asked.column(c).chunks, *back.column(c).chunks]) for c in ("block", "bucket", "kind")]
    return pa.table([*columns, pa.array(bits + back.column("k1").to_pylist(), pa.binary())], ["block", "bucket", "kind", "bits"])


def _removed(block: pa.Table, ids: np.ndarray, replies: pa.Table, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row number and removal of every word of a block."""
    mask = [b.as_py() for b, k in zip(replies.column("bits"), replies.column("kind")) if k.as_py() == 1]
    if not mask:
        row = _words(block, 0)[1]
        return row, np.zeros(len(row), bool)
    candidate = np.unpackbits(np.frombuffer(mask[0], np.uint8)).astype(bool)
    row, at, k1, _, order, start = _window_groups(block, candidate, width)
    sizes = np.diff(np.append(start, len(order)))
    earlier = np.repeat(bits_of(replies, k1[order[start]], n), sizes)
    owner = row[at[order]]
    lead = np.repeat(owner[start], sizes)
    again = np.concatenate([[False], owner[1:] == owner[:-1]])  # earlier in the same document
    again[start] = False
    gone = at[order[earlier | (ids[lead] < ids[owner]) | again]]
    edge = np.zeros(len(row) + 1, np.int64)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + width, -1)
    return row, np.cumsum(edge[:-1]) > 0


def _remove(n: int, anchor: int):
    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_words": [], "n_removed": [], "kept": []}
        if len(block):
            block, ids = ordered(block)
            row, gone = _removed(block, ids, replies, n, 2 * anchor)
            edges = np.searchsorted(row, np.arange(len(block) + 1))
            stay = ~gone
            for i, text in enumerate(block.column("text")):
                words = text.as_py().encode().split()
                part = stay[edges[i] : edges[i + 1]]
                kept = words if part.all() else list(compress(words, part.tolist()))
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept"].append(b" ".join(kept))
            out["doc_id"] = block.column("doc_id").combine_chunks()
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array(v, t) if isinstance(v, list) else v.cast(t) for v, t in zip(out.values(), types)], list(out))

    return run


def without_repeats(docs: DataFrame, anchor: int = ANCHOR) -> DataFrame:
    """One row per document: its words, how many are removed, and the kept words joined by blanks."""
    texts_, n = in_blocks(docs)
    by_block = texts_.groupBy("block")
    probes = by_block.applyInArrow(_ask_probes(n, anchor), _PROBES)
    hits = answered(probes, _answer_probes)
    windows = by_block.cogroup(hits.groupBy("block")).applyInArrow(_ask_windows(n, anchor), _WINDOWS)
    earlier = windows.groupBy("bucket").applyInArrow(_answer_windows, REPLY)
    return by_block.cogroup(earlier.groupBy("block")).applyInArrow(
        _remove(n, anchor), "doc_id long, n_words long, n_removed long, kept binary"
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = {
    "op7_substring_dedup": r"""
with words as (
    select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w
    from documents
),
windows as (
    select doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) as g
    from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from words where len(w) >= 20)
),
gone as (
    select doc_id, i from (
        select doc_id, i, row_number() over (partition by g order by doc_id, i) as k from windows
    ) where k > 1
),
starts as (
    select doc_id, i, max(i) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) as p
    from gone
),
lost as (select doc_id, unnest(range(greatest(i, coalesce(p + 20, 0)), i + 20)) as i from starts),
placed as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from words),
kept as (
    select p.doc_id, string_agg(word, ' ' order by p.i) as t, count(*) as n
    from placed p left join lost l on p.doc_id = l.doc_id and p.i = l.i where l.i is null group by p.doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, (len(d.w) - coalesce(k.n, 0))::bigint as n_removed,
    sha256(coalesce(k.t, '')) as kept_sha256
from words d left join kept k on k.doc_id = d.doc_id
""",
}
