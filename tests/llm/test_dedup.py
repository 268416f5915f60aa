"""SimHash, suffix-array and substring dedup against brute force on small tables."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ledgerline.llm import blocks, induced_sort, simhash, substring_dedup, suffix_dedup

LAST = 1 << 62


def corpus(seed, n=60):
    """Texts that share passages, words and whole copies."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 9))) for _ in range(80)]
    passages = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(18, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 30)))]
        for _ in range(rnd.randrange(3)):
            parts += [rnd.choice(passages), rnd.choice(vocabulary)]
        rows.append((i * 3, rnd.choice([" ", "\n", "  "]).join(parts)))
    for i in range(0, n, 7):
        rows.append((i * 3 + 1, rows[i][1]))
    return rows


def brute_fingerprint(text):
    words = (text or "").encode()
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in words).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=2):
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if bin(prints[i] ^ prints[j]).count("1") <= distance and group[j] < group[i]:
                    group[i], changed = group[j], True
    least = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            least[g] = min(least.get(g, LAST), doc_id)
    return sorted(((d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, group)), key=repr)


def near_copies(seed):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice("the of and to a in is it on as red bolt".split()) for _ in range(150)) for _ in range(8)]
    rows = []
    for i in range(50):
        words = rnd.choice(base).split()
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(len(words))] = rnd.choice(["x", "y", "The"])
        rows.append((100 - i, " ".join(words)))
    return rows + [(200, None), (201, ""), (202, "One"), (203, "one "), (204, "one two"), (7, rows[0][1]), (7, rows[0][1])]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_simhash_matches_brute_force(docs):
    rows = near_copies(3)
    assert rows_of(simhash.near_duplicates(docs(rows))) == brute_components(rows)


def test_chains_of_links_are_one_component(spark):
    """Fingerprints 2 bits apart, in a chain and a ring, and one that stands alone."""
    rnd = random.Random(5)
    chain, now = [], 0
    for i in range(60):
        now ^= (1 << i) | (1 << (i + 1))
        chain.append(now - (1 << 64) if now >> 63 else now)
    alone = 0x5555555555555555
    rnd.shuffle(chain)
    prints = spark.createDataFrame([(p,) for p in [*chain, alone]], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(prints)).collect()}
    assert {roots.get(p, p) for p in chain} == {min(chain)}
    assert alone not in roots


def test_links_join_all_pairs_within_the_distance(spark):
    rnd = np.random.default_rng(2)
    base = rnd.integers(-(1 << 62), 1 << 62, 20)
    prints = sorted({int(b) ^ m for b in base for m in (0, 1, 6, 7, 1 << 40, (1 << 40) | 8)})
    edges = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()}
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 2 and a < b for a, b in edges)
    group = {p: p for p in prints}
    for _ in prints:
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    for a in prints:
        for b in prints:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                assert group[a] == group[b]


def test_keep_one_leaves_one_row_of_each_group(docs):
    rows = near_copies(4) + [(None, "a b c d e f"), (None, "a b c d e f")]
    kept = rows_of(simhash.keep_one(docs(rows)))
    expected = {}
    for doc_id, fp, component in brute_components(rows):
        expected.setdefault((component, None if component is not None else fp), []).append(doc_id)
    assert len(kept) == len(expected)
    assert {r[0] for r in kept} == {component for component, _ in expected}


def test_simhash_edge_cases(hard, empty):
    out = simhash.near_duplicates(hard).collect()
    assert len(out) == hard.count()
    zero = {r.doc_id: r.component_id for r in out if r.fingerprint == "0" * 16}
    assert zero == {2: 2, 3: 2, 4: 2}
    assert {r.component_id for r in out if r.doc_id in (1, 8)} == {1}
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []
    kept = simhash.keep_one(hard)
    assert kept.columns == hard.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 5, 6, 7]


@pytest.mark.parametrize("seed", range(6))
def test_suffixes_are_sorted_with_their_common_prefixes(seed):
    rnd = np.random.default_rng(seed)
    for round_ in range(40):
        n_symbols = int(rnd.choice([3, 5, 258, 900]))
        text = rnd.integers(1, n_symbols, int(rnd.integers(1, 90)))
        text = np.append(np.tile(text, int(rnd.integers(1, 4))), 0)
        order, common = induced_sort.sort_suffixes(text, n_symbols, induced_sort.CLIP, 1 << 20 if round_ % 2 else 40)
        suffixes = [tuple(text[i:].tolist()) for i in range(len(text))]
        expected = sorted(range(len(text)), key=suffixes.__getitem__)
        assert order.tolist() == expected
        if n_symbols <= 512:
            for a, b, c in zip(expected, expected[1:], common.tolist()[1:]):
                assert suffixes[a][:c] == suffixes[b][:c]
                assert c == induced_sort.CLIP or suffixes[a][: c + 1] != suffixes[b][: c + 1]


@pytest.mark.parametrize("memory", [1 << 20, 300])
def test_repeated_prose_is_sorted(memory):
    """Texts with long equal parts, so that substrings between seeds tie at every length."""
    rnd = random.Random(memory)
    for _ in range(4):
        vocabulary = ["".join(rnd.choice("abcdeno ") for _ in range(rnd.randrange(1, 12))) for _ in range(60)]
        parts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(5, 60))) for _ in range(8)]
        data = ".".join(rnd.choice(parts) for _ in range(30)).encode()
        data += bytes(rnd.randrange(97, 123) for _ in range(3000)) + data[: len(data) // 2]
        text = np.append(np.frombuffer(data, np.uint8).astype(np.int64) + 2, 0)
        order, common = induced_sort.sort_suffixes(text, 258, induced_sort.CLIP, memory)
        expected = [len(data), *sorted(range(len(data)), key=lambda i: data[i:])]
        assert order.tolist() == expected
        for a, b, c in zip(expected, expected[1:], common.tolist()[1:]):
            assert data[a : a + c] == data[b : b + c]
            assert c == induced_sort.CLIP or data[a : a + c + 1] != data[b : b + c + 1]


def test_names_that_fit_in_memory_need_no_further_passes(monkeypatch):
    """Two passes for a text whose names fit in memory, four or more where they do not, in the same order."""
    made = []
    init = induced_sort._Pass.__init__

    def counted(self, *args):
        made.append(self)
        init(self, *args)

    monkeypatch.setattr(induced_sort._Pass, "__init__", counted)
    rng = np.random.default_rng(3)
    period = np.tile(rng.integers(2, 258, 7), 600)
    for body in (rng.integers(2, 40, 5000), period, np.append(period, rng.integers(2, 5, 4000))):
        text = np.append(body, 0)
        passes, found = [], []
        for memory in (1 << 20, 300):
            made.clear()
            found.append(induced_sort.sort_suffixes(text, 258, 50, memory))
            passes.append(len(made))
        assert passes[0] == 2 and passes[1] >= 4
        assert all(a.tolist() == b.tolist() for a, b in zip(*found))


@pytest.mark.parametrize("seed", range(4))
def test_names_are_sorted_in_memory(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        part = rng.integers(1, int(rng.choice([2, 3, 20])), int(rng.integers(1, 60)))
        names = np.append(np.tile(part, int(rng.integers(1, 5))), 0)
        names = np.unique(names, return_inverse=True)[1]
        expected = sorted(range(len(names)), key=lambda i: names[i:].tolist())
        assert induced_sort._sorted_in_memory(names).tolist() == expected


def test_queue_gives_back_what_went_to_disk():
    queue = induced_sort.Queue(3, memory=10)
    pushed = {0: [], 1: [], 2: []}
    for i in range(40):
        part = np.arange(i, i + i % 4)
        queue.push(i % 3, part, part.astype(np.uint8))
        pushed[i % 3] += part.tolist()
    assert queue.files
    for lane in range(3):
        runs = queue.pop(lane)
        assert [x for p, _ in runs for x in p.tolist()] == pushed[lane]
        assert [x for _, c in runs for x in c.tolist()] == pushed[lane]
        assert queue.pop(lane) == []


def brute_bytes(rows, width=50):
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            key = data[i : i + width]
            first[key] = min(first.get(key, LAST), doc_id if doc_id is not None else LAST)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < (doc_id if doc_id is not None else LAST):
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digest3(df):
    return sorted(
        (
            (r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
            for r in df.collect()
        ),
        key=repr,
    )


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_matches_brute_force(docs, seed):
    rows = corpus(seed) + [(1000, "ab" * 120), (1001, "ab" * 70 + "c"), (1002, "ba" * 26), (None, "ab" * 40), (5, None)]
    assert digest3(suffix_dedup.without_repeated_strings(docs(rows))) == brute_bytes(rows)


def test_suffix_dedup_sorts_shards_larger_than_memory(monkeypatch):
    rnd = random.Random(9)
    base = bytes(rnd.choice(b"abc") for _ in range(400))
    fragments = [base[a : a + 90] for a in range(0, 300, 13)]
    ids = np.array([rnd.randrange(9) for _ in fragments])
    first = {}
    for f, i in zip(fragments, ids.tolist()):
        for a in range(len(f) - 49):
            first[f[a : a + 50]] = min(first.get(f[a : a + 50], 99), i)
    monkeypatch.setattr(induced_sort, "MEMORY", 64)
    for f, least in zip(fragments, suffix_dedup.least_ids(fragments, ids, 50)):
        assert least.tolist() == [first[f[a : a + 50]] for a in range(len(f) - 49)]


@pytest.mark.parametrize("width", [32, 33, 50])
def test_fragments_left_unsorted_share_no_string(width):
    """Over texts of few symbols, whose anchors recur, and copies that differ left or right of them."""
    rnd = random.Random(width)
    made = set()
    for symbols in (b"a", b"ab", b"abcdefgh"):
        for _ in range(40):
            text = bytes(rnd.choice(symbols) for _ in range(rnd.randrange(width, 3 * width)))
            cut, other = rnd.randrange(len(text)), bytes(rnd.choice(symbols) for _ in range(width))
            made |= {text, text[:cut] + other, other + text[cut:]}
    # One anchor a fragment, as the shards get them.
    block = pa.table({"text": [t.decode() for t in sorted(made) if len(t) >= width]})
    fragments = sorted({p[a : a + n + width - 1].tobytes() for p, _, _, _, b, c, _ in suffix_dedup._runs(block, width) for a, n in zip(b, c)})
    kept = set(suffix_dedup._contested(np.arange(len(fragments)), fragments, width).tolist())
    holders = {}
    for i, f in enumerate(fragments):
        for a in range(len(f) - width + 1):
            holders.setdefault(f[a : a + width], set()).add(i)
    shared = set().union(*(h for h in holders.values() if len(h) > 1))
    assert shared and shared <= kept and len(kept) < len(fragments)
    assert len(suffix_dedup._contested(np.arange(0), [], width)) == 0


def test_suffix_dedup_edge_cases(hard, empty):
    out = digest3(suffix_dedup.without_repeated_strings(hard))
    plain = [(r.doc_id, r.text) for r in hard.collect() if r.doc_id not in (6, 7)]
    assert [r for r in out if r[0] not in (6, 7)] == brute_bytes(plain)
    assert [r[2] for r in out if r[0] in (6, 7)] == [0, 0]
    assert suffix_dedup.without_repeated_strings(empty).collect() == []


def brute_words(rows, width=20):
    first = {}
    for at, (doc_id, text) in enumerate(rows):
        words = (text or "").encode().split()
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            first.setdefault(key, []).append((doc_id if doc_id is not None else LAST, at, i))
    out = []
    for at, (doc_id, text) in enumerate(rows):
        words = (text or "").encode().split()
        own = doc_id if doc_id is not None else LAST
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if any(d < own or (a == at and j < i) for d, a, j in first[tuple(words[i : i + width])]):
                gone[i : i + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digest7(df):
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup_matches_brute_force(docs, seed):
    rows = corpus(seed + 10) + [(900, "a b " * 30), (901, "b a " * 13 + "c"), (None, "a b " * 11), (2, None), (2, "a b " * 12)]
    assert digest7(substring_dedup.without_repeats(docs(rows))) == brute_words(rows)


def test_substring_dedup_edge_cases(hard, empty):
    out = digest7(substring_dedup.without_repeats(hard))
    plain = [(r.doc_id, r.text) for r in hard.collect() if r.doc_id != 7]
    assert [r for r in out if r[0] != 7] == brute_words(plain)
    assert [r[1:3] for r in out if r[0] == 7] == [(60_000, 59_998)]
    assert substring_dedup.without_repeats(empty).collect() == []


def test_many_small_blocks_give_the_same_result(docs, monkeypatch):
    rows = corpus(21)
    monkeypatch.setattr(blocks.in_blocks, "__defaults__", (200,))
    assert digest7(substring_dedup.without_repeats(docs(rows))) == brute_words(rows)
    assert digest3(suffix_dedup.without_repeated_strings(docs(rows))) == brute_bytes(rows)
