"""Repeated byte strings by suffix sorting.

Every string of ``width`` bytes has an anchor, the least hash of the short strings in it, and equal strings
have equal anchors. So strings are dealt to shards by anchor: the strings of one anchor that follow each
other in a document travel as one fragment of its text. Only anchors that occur in two documents matter,
which is found out first, by cells of distinct anchors (:mod:`ledgerline.llm.blocks`). A block of
documents sends equal fragments once, with the smallest id, so a passage that a third of all documents
share is one fragment per block.

A shard sorts the suffixes of its fragments by external induced sorting, with common prefixes; suffixes
next to each other that share ``width`` bytes are one string, and the smallest id among them tells each
block which of its strings start in an earlier document. An anchor whose fragments are all equal needs no
sorting: its strings are as equal as the fragments. Nor does a fragment that agrees with no other one on
either side of the anchor, where an equal string would agree on one. Anchors are sorted in portions of a shard; only one
anchor that is larger than a portion makes a larger one. The answer is one bit per string.

Texts are UTF-8 bytes, strings never cross documents, and all are judged on the input. Defined results: a
null text is empty; a null id comes after all others; rows with equal ids are not before each other; an
empty table gives an empty result.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import induced_sort
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
from ledgerline.llm.text_arrays import byte_hashes, chunks, mixed, texts

WIDTH = 50
#: Bytes of the short strings whose least hash is a string's anchor.
SHORT = 16
#: Fragments of different anchors share no string, so a shard is sorted in portions of about this size.
SORT_BYTES = 1 << 21
#: Fragments whose anchors are looked up at a time.
_AT_ONCE = 1 << 14

_ANCHORS = "bucket long, block long, high binary, low binary, flags binary"
_FRAGMENTS = "bucket long, block long, kind int, keys binary, sizes binary, data binary, ids binary"
_ANCHOR_MASK = ~np.uint64(0xFFFF)


def _short_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from every place on."""
    data = raw.tobytes()
    eight = np.empty(len(raw) - 7, np.uint64)
    for shift in range(8):
        count = (len(raw) - shift) // 8
        eight[shift::8] = np.frombuffer(data, "<u8", count, shift)
    return mixed(eight[:-8] * np.uint64(0x9E3779B97F4A7C15) + eight[8:])


def _runs(block: pa.Table, width: int):
    """Runs of strings with one anchor: row, first string's place in its chunk, number of strings, anchor;
    by chunk, with the bytes of the chunk and where its texts begin."""
    raw, offsets = texts(block.column("text"))
    for a, b in chunks(offsets, 1 << 20):
        part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if len(part) < width:
            continue
        least = _short_hashes(part)
        span, reach = width - SHORT + 1, 1
        while 2 * reach <= span:
            least = np.minimum(least[: len(least) - reach], least[reach:])
            reach *= 2
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
        n = len(part) - width + 1
        inside = np.zeros(n + 1, np.int8)
        first, last = at[:-1], at[1:] - width + 1
        whole = last > first
        np.add.at(inside, first[whole], 1)
        np.add.at(inside, last[whole], -1)
        inside = np.cumsum(inside[:n]) > 0
        new = inside.copy()
        new[1:] &= (least[1:n] != least[: n - 1]) | ~inside[:-1]
        starts = at[:-1]
        new[starts[(starts < n) & whole]] = True
        end = inside.copy()
        end[:-1] &= new[1:] | ~inside[1:]
        begin, stop = np.flatnonzero(new), np.flatnonzero(end) + 1
        row = np.searchsorted(at, begin, "right") - 1
        # Least hashes are small numbers; mixed again, they spread evenly over the ranges.
        yield part, at, a, row + a, begin, stop - begin, mixed(least[begin]) & _ANCHOR_MASK


def _ask_anchors(n: int, width: int):
    def run(block: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        block, ids = ordered(block)
        found = [(ids[row], key) for *_, row, _, _, key in _runs(block, width)]
        rows = {c: [] for c in ("bucket", "block", "high", "low", "flags")}
        if found:
            owner, key = (np.concatenate(x) for x in zip(*found))
            order, first = groups_of(key)
            owner, distinct = owner[order], key[order][first]
            many = (np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)) if len(first) else first > 0
            buckets, edges = cell_edges(distinct, n)
            high = (distinct >> np.uint64(48)).astype(np.uint16)
            low = (distinct >> np.uint64(16)).astype(np.uint32)
            flags = many.astype(np.uint8)
            for bucket, a, b in zip(buckets.tolist(), edges[:-1], edges[1:]):
                for c, v in zip(rows, (bucket, number, high[a:b].tobytes(), low[a:b].tobytes(), flags[a:b].tobytes())):
                    rows[c].append(v)
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))

    return run


def _answer_anchors(cells: pa.Table) -> list[np.ndarray]:
    """Whether an anchor occurs in two documents."""
    high, edges = joined(cells.column("high"), np.uint16)
    low, _ = joined(cells.column("low"), np.uint32)
    flags, _ = joined(cells.column("flags"), np.uint8)
    key = (high.astype(np.uint64) << np.uint64(32)) | low
    order, first = groups_of(key)
    hit = np.zeros(len(key), bool)
    if len(first):
        sizes = np.diff(np.append(first, len(key)))
        hit[order] = np.repeat((np.maximum.reduceat(flags[order], first) > 0) | (sizes > 1), sizes)
    return [hit[a:b] for a, b in zip(edges[:-1], edges[1:])]


def _fragments(runs: list, hit: np.ndarray, width: int):
    """The distinct fragments of a block's hit runs: key, bytes, row of the first one, and the runs of each.

    ``runs`` is in the order of the rows, so the first has the least id."""
    key, row, size, h1, h2, place, data = [], [], [], [], [], [], []
    at = 0
    for part, _, _, rows, begin, count, keys in runs:
        use = hit[at : at + len(rows)]
        at += len(rows)
        first, stop = begin[use], begin[use] + count[use] + width - 1
        key.append(keys[use])
        row.append(rows[use])
        size.append(count[use])
        h1.append(byte_hashes(part, first, stop, 0))
        h2.append(byte_hashes(part, first, stop, 1))
        place.append(np.stack([np.full(len(first), len(data)), first, stop], 1))
        data.append(part)
    key, row, size, h1, h2 = (np.concatenate(x) for x in (key, row, size, h1, h2))
    order, start = groups_of(key, h1, h2, size.astype(np.uint64))
    return key, row, size, np.concatenate(place), data, order, start


def _ask_fragments(n: int, width: int):
    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        out = {c: [] for c in ("bucket", "block", "kind", "keys", "sizes", "data", "ids")}
        runs = []
        if len(block):
            number = block.column("block")[0].as_py()
            block, ids = ordered(block)
            runs = list(_runs(block, width))
        if runs:
            key = np.concatenate([r[-1] for r in runs])
            order, first = groups_of(key)
            hit = np.zeros(len(key), bool)
            bits = bits_of(replies, key[order][first], n)
            hit[order] = np.repeat(bits, np.diff(np.append(first, len(key))))
            if hit.any():
                key, row, size, place, data, order, start = _fragments(runs, hit, width)
                lead = order[start]
                key, own, size = key[lead], ids[row[lead]], size[lead].astype(np.int32)
                texts_ = [data[c][a:b].tobytes() for c, a, b in place[lead].tolist()]
                buckets, edges = cell_edges(key, n)
                short = (key >> np.uint64(16)).astype(np.uint32)
                cells = [
                    (int(c), 0, short[a:b].tobytes(), size[a:b].tobytes(), b"".join(texts_[a:b]), own[a:b].tobytes())
                    for c, a, b in zip(buckets, edges[:-1], edges[1:])
                ]
                # The block's own hits come back as they are.
                cells.append((number % n, 1, np.packbits(hit).tobytes(), b"", b"", b""))
                for bucket, *rest in cells:
                    for c, v in zip(out, (bucket, number, *rest)):
                        out[c].append(v)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

    return run


def least_ids(fragments: list[bytes], ids: np.ndarray, width: int) -> list[np.ndarray]:
    """For each fragment, the smallest id among the fragments that hold each of its strings."""
    sizes = np.array([len(f) for f in fragments])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    # Symbols: 0 the end, 1 between fragments, and the bytes from 2 on.
    text = np.ones(starts[-1] + 1, np.int32)
    raw = np.frombuffer(b"\0".join(fragments), np.uint8)
    text[: len(raw)] = raw.astype(np.int32) + 2
    text[starts[1:] - 1] = 1
    text[-1] = 0
    order, common = induced_sort.sort_suffixes(text, int(text.max()) + 1, width, induced_sort.MEMORY)
    group = np.flatnonzero(np.append(True, common[1:] < width))
    of = np.append(np.repeat(ids, sizes + 1), np.iinfo(np.int64).max)[order]
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(of, group), np.diff(np.append(group, len(order))))
    return [least[a : a + size - width + 1] for a, size in zip(starts[:-1], sizes)]


def _portions(differ: np.ndarray, anchor: np.ndarray, fragments: list[bytes]):
    """Fragments to be sorted together: those of one anchor always, in portions of about ``SORT_BYTES``."""
    differ = differ[np.argsort(anchor[differ], kind="stable")]
    if not len(differ):
        return
    before = np.cumsum([0, *(len(fragments[i]) + 1 for i in differ[:-1])])
    first = np.append(True, anchor[differ][1:] != anchor[differ][:-1])
    portion = np.maximum.accumulate(np.where(first, before // SORT_BYTES, 0))
    yield from np.split(differ, np.flatnonzero(np.diff(portion)) + 1)


def _beside_anchors(fragments: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of what stands to the left and to the right of every anchor, and the fragment of each key.

    An equal string has its anchor at one place in both fragments, and so many bytes of the string on one
    side of it that one of these keys is equal, too."""
    reach = min(SHORT, (width - SHORT + 1) // 2)
    sizes = np.array([len(f) for f in fragments])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    short = _short_hashes(np.frombuffer(b"".join(fragments), np.uint8))
    n_short = sizes - SHORT + 1
    first = np.cumsum(n_short) - n_short
    own = np.repeat(np.arange(len(sizes)), n_short)
    place = np.arange(len(own)) + (starts[:-1] - first)[own]
    hashes = short[place]
    least = np.minimum.reduceat(hashes, first)
    anchor = np.flatnonzero(hashes == least[own])
    at, own = place[anchor], own[anchor]
    keys = []
    for side, beside in enumerate((at - reach, at + reach)):
        inside = (beside >= starts[own]) & (beside + SHORT <= starts[own + 1])
        keys.append((mixed(short[beside[inside]] * np.uint64(31) + least[own[inside]] + np.uint64(side)), own[inside]))
    return tuple(np.concatenate(k) for k in zip(*keys))


def _contested(differ: np.ndarray, fragments: list[bytes], width: int) -> np.ndarray:
    """Those fragments that may share a string with another one, by the bytes beside their anchors."""
    found = []
    for a in range(0, len(differ), _AT_ONCE):
        part = differ[a : a + _AT_ONCE]
        key, own = _beside_anchors([fragments[i] for i in part], width)
        found.append((key, part[own]))
    if not found:
        return differ
    key, own = (np.concatenate(x) for x in zip(*found))
    order, first = groups_of(key)
    own = own[order]
    many = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
    return np.unique(own[np.repeat(many, np.diff(np.append(first, len(own))))])


def _answer_fragments(width: int):
    def run(cells: pa.Table) -> pa.Table:
        asked = cells.filter(pc.equal(cells.column("kind"), 0))
        keys, edges = joined(asked.column("keys"), np.uint32)
        counts, _ = joined(asked.column("sizes"), np.int32)
        ids, _ = joined(asked.column("ids"), np.int64)
        fragments, number, known = [], np.zeros(len(keys), np.int64), {}
        at = 0
        for data, a, b in zip(asked.column("data"), edges[:-1].tolist(), edges[1:].tolist()):
            data, shift = data.as_py(), 0
            for i in range(a, b):
                size = int(counts[i]) + width - 1
                fragment = data[shift : shift + size]
                shift += size
                number[i] = at = known.setdefault(fragment, len(known))
                if at == len(fragments):
                    fragments.append(fragment)
        least_id = np.full(len(fragments), np.iinfo(np.int64).max)
        np.minimum.at(least_id, number, ids)
        key_of = np.zeros(len(fragments), np.uint32)
        key_of[number] = keys
        _, where, sizes = np.unique(key_of, return_inverse=True, return_counts=True)
        differ = np.flatnonzero(sizes[where] > 1)  # fragments that others of their anchor differ from
        least = {}
        for part in _portions(_contested(differ, fragments, width), where, fragments):
            least |= zip(part.tolist(), least_ids([fragments[i] for i in part], least_id[part], width))
        flags = np.repeat(least_id[number] < ids, counts)
        ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        sorted_ = np.zeros(len(fragments), bool)
        sorted_[list(least)] = True
        for i in np.flatnonzero(sorted_[number]).tolist():
            flags[ends[i] : ends[i + 1]] = least[int(number[i])] < ids[i]
        bits = [np.packbits(flags[ends[a] : ends[b]]).tobytes() for a, b in zip(edges[:-1], edges[1:])]
        back = cells.filter(pc.equal(cells.column("kind"), 1))
        columns = [pa.concat_arrays([*asked.column(c).chunks, *back.column(c).chunks]) for c in ("block", "bucket", "kind")]
        data = pa.array(bits + back.column("keys").to_pylist(), pa.binary())
        return pa.table([*columns, data], ["block", "bucket", "kind", "bits"])

    return run


def _removed_strings(block: pa.Table, ids: np.ndarray, replies: pa.Table, n: int, width: int):
    """Row and place in its chunk of every string that starts in an earlier document, by chunk."""
    mask = [b.as_py() for b, k in zip(replies.column("bits"), replies.column("kind")) if k.as_py() == 1]
    if not mask:
        return
    runs = list(_runs(block, width))
    n_runs = sum(len(r[-1]) for r in runs)
    hit = np.unpackbits(np.frombuffer(mask[0], np.uint8), count=n_runs).astype(bool)
    key, row, size, place, data, order, start = _fragments(runs, hit, width)
    lead = order[start]
    # The answers: a bit for each string of each distinct fragment, by cell.
    buckets, edges = cell_edges(key[lead], n)
    of_bucket = dict(zip(buckets.tolist(), zip(edges[:-1].tolist(), edges[1:].tolist())))
    ends = np.concatenate([[0], np.cumsum(size[lead])])
    bits = np.zeros(ends[-1], bool)
    for bucket, kind, reply in zip(*(replies.column(c) for c in ("bucket", "kind", "bits"))):
        if kind.as_py() == 0:
            a, b = of_bucket[bucket.as_py()]
            bits[ends[a] : ends[b]] = np.unpackbits(np.frombuffer(reply.as_py(), np.uint8), count=ends[b] - ends[a])
    group = np.zeros(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(order))))
    later = ids[row[lead]][group] < ids[row]  # than the same fragment in this block
    # One entry for each string of each run.
    total = np.repeat(np.arange(len(row)), size)
    step = np.arange(len(total)) - np.repeat(np.cumsum(size) - size, size)
    gone = later[total] | bits[ends[group[total]] + step]
    total, step = total[gone], step[gone]
    chunk = place[:, 0][total]
    for c, run in enumerate(runs):
        own = chunk == c
        yield run, place[:, 1][total[own]] + step[own]


def _remove(n: int, width: int):
    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        out = {"n_bytes": [], "spans": [], "kept": []}
        ids_out = pa.array([], pa.int64())
        if len(block):
            block, ids = ordered(block)
            ids_out = block.column("doc_id").combine_chunks()
            raw, offsets = texts(block.column("text"))
            cover = np.zeros(len(raw) + 1, np.int32)
            for (_, at, a, *_), place in _removed_strings(block, ids, replies, n, width):
                # Every string is in one run, so no place comes twice.
                shifted = place + offsets[a]
                cover[shifted] += 1
                cover[shifted + width] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            for i in range(len(block)):
                part, lost = raw[offsets[i] : offsets[i + 1]], gone[offsets[i] : offsets[i + 1]]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], lost.view(np.int8), [0]]))).reshape(-1, 2)
                out["n_bytes"].append(len(part))
                out["spans"].append([{"start": int(a), "stop": int(b)} for a, b in edge])
                out["kept"].append(part[~lost].tobytes() if len(edge) else part.tobytes())
        spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        columns = [ids_out.cast(pa.int64()), pa.array(out["n_bytes"], pa.int64()), pa.array(out["spans"], spans), pa.array(out["kept"], pa.binary())]
        return pa.table(columns, ["doc_id", "n_bytes", "spans", "kept"])

    return run


def without_repeated_strings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: its bytes, the spans removed, and the bytes kept."""
    if not 2 * SHORT <= width <= 254:
        raise ValueError(f"the width must be from {2 * SHORT} to 254 bytes")
    texts_, n = in_blocks(docs)
    by_block = texts_.groupBy("block")
    hits = answered(by_block.applyInArrow(_ask_anchors(n, width), _ANCHORS), _answer_anchors)
    fragments = by_block.cogroup(hits.groupBy("block")).applyInArrow(_ask_fragments(n, width), _FRAGMENTS)
    earlier = fragments.groupBy("bucket").applyInArrow(_answer_fragments(width), REPLY)
    return by_block.cogroup(earlier.groupBy("block")).applyInArrow(
        _remove(n, width), "doc_id long, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary"
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeated_strings(table(spark, sf_dir, "documents"))
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s.stop - s.start)
    return cleaned.select(
        "doc_id",
        "n_bytes",
        lost.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLE = {
    "op3_suffix_dedup": """
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
strings as (
    select doc_id, i, md5(substr(h, 2 * i + 1, 100)) as g
    from (select doc_id, h, unnest(range(0, length(h) // 2 - 49)) as i from docs where length(h) >= 100)
),
gone as (
    select doc_id, i from (select doc_id, i, min(doc_id) over (partition by g) as first from strings)
    where first < doc_id
),
edges as (
    select doc_id, i, lag(i) over (partition by doc_id order by i) as p, lead(i) over (partition by doc_id order by i) as q
    from gone
),
-- The start of each removed run, and its end, pair up in order.
starts as (
    select doc_id, i, row_number() over (partition by doc_id order by i) as k from edges where p is null or i > p + 50
),
stops as (
    select doc_id, i + 50 as j, row_number() over (partition by doc_id order by i) as k from edges
    where q is null or q > i + 50
),
spans as (select s.doc_id, s.k, s.i, t.j from starts s join stops t on s.doc_id = t.doc_id and s.k = t.k),
pieces as (
    select doc_id, k, coalesce(lag(j) over (partition by doc_id order by k), 0) as a, i as b from spans
    union all select doc_id, max(k) + 1, max(j), null from spans group by doc_id
),
kept as (
    select p.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' order by k) as h
    from pieces p join docs d on p.doc_id = d.doc_id group by p.doc_id
),
counts as (select doc_id, sum(j - i)::bigint as n_removed, count(*) as n_spans from spans group by doc_id)
select d.doc_id, (length(d.h) // 2)::bigint as n_bytes, coalesce(c.n_removed, 0)::bigint as n_removed,
    coalesce(c.n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(k.h, d.h))) as kept_sha256
from docs d left join counts c on c.doc_id = d.doc_id left join kept k on k.doc_id = d.doc_id
""",
}
