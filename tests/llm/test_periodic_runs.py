"""Runs of words against a search of every start and period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import periodic_runs


def brute_runs(words, least=6, times=4):
    """(start, length, period) by start and period: every stretch that no neighbour extends, with its smallest period."""
    best = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                best.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_row(doc_id, text):
    own = words_of(text)
    words, n = list(own), len(own)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [own[a + (i - a) % p] if i >= a else own[i] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    shown = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *shown, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        texts = []
        for _ in range(rnd.randrange(1, 6)):
            k = rnd.choice([1, 2, 3, 10])
            text = [rnd.randrange(k) for _ in range(rnd.randrange(60))]
            if text and rnd.random() < 0.6:
                a, p = rnd.randrange(len(text)), rnd.randrange(1, 9)
                text = [text[i] if i < a else text[min(a + (i - a) % p, len(text) - 1)] for i in range(len(text))]
                text += [rnd.randrange(k) for _ in range(rnd.randrange(5))]
            texts.append(text)
        edges = np.cumsum([0] + [len(t) for t in texts])
        found = periodic_runs.runs_of(np.array([w for t in texts for w in t], np.int64), edges)
        wanted = [(i, *run) for i, t in enumerate(texts) for run in brute_runs(t)]
        assert [tuple(r) for r in found.tolist()] == wanted


@pytest.mark.parametrize(("least", "times"), [(4, 4), (9, 4), (20, 5)])
def test_other_bounds(least, times):
    rnd = random.Random(least)
    text = [rnd.randrange(2) for _ in range(400)] + [1, 0, 0] * 20
    found = periodic_runs.runs_of(np.array(text, np.int64), np.array([0, len(text)]), least, times)
    assert [tuple(r[1:]) for r in found.tolist()] == brute_runs(text, least, times)
    with pytest.raises(ValueError, match="four times"):
        periodic_runs.runs_of(np.array(text, np.int64), np.array([0, len(text)]), least, 3)


def test_long_texts_in_reasonable_time():
    n = 60_000
    for text, wanted in ((np.zeros(n, np.int64), [0, 0, n, 1]), (np.arange(n) % 777, [0, 0, n, 777])):
        assert periodic_runs.runs_of(text, np.array([0, n])).tolist() == [wanted]


def test_equal_texts_side_by_side_are_kept_apart():
    text = [1, 2, 3] * 3
    edges = np.array([0, 9, 18, 18, 27])
    assert not len(periodic_runs.runs_of(np.array(text * 3, np.int64), edges))


def query_rows(spark, docs, path):
    docs.write.parquet(f"{path}/documents.parquet")
    return sorted((tuple(r) for r in periodic_runs.op13_periodic_runs(spark, str(path)).collect()), key=repr)


def test_query_rows_with_planted_repeats(spark, docs, tmp_path):
    rnd = random.Random(4)
    rows = []
    for i in range(150):
        words = [rnd.choice(["a", "b", "ç", "the", "ÿ漢"]) for _ in range(rnd.randrange(120))]
        rows.append((i, rnd.choice([" ", "\n", " \t"]).join(words) + rnd.choice(["", " x" * 9])))
    rows += [(-7, "a b c d e f g h i j"), (3, "u v w u v w u v w u v w"), (3, "u v w u v w u v w u v w")]
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t in rows)
    found = query_rows(spark, docs(rows), tmp_path)
    assert found == sorted((brute_row(*r) for r in rows), key=repr)


def test_query_rows_of_hard_cases(spark, hard, tmp_path):
    found = query_rows(spark, hard, tmp_path)
    rows = [(r.doc_id, r.text) for r in hard.collect() if r.doc_id != 7]
    assert [r for r in found if r[0] != 7] == sorted((brute_row(*r) for r in rows), key=repr)
    assert [r[:6] for r in found if r[0] == 7] == [(7, 1, 0, 60_000, 2, 30_000_000)]


def test_real_outputs_and_small_chunks(docs, empty, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK", 30)
    rows = [(i, "start " + "go on " * (i % 5) + "end") for i in range(20)]
    for r in periodic_runs.periodic_runs(docs(rows)).collect():
        repeats = r.doc_id % 5
        assert [tuple(x) for x in r.runs] == ([(1, 8, 2)] if repeats == 4 else [])
        assert r.collapsed == ("start go on end" if repeats == 4 else " ".join(words_of(rows[r.doc_id][1])))
        assert r.n_words == 2 + 2 * repeats
    assert periodic_runs.periodic_runs(empty).collect() == []
