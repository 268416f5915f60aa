"""Spelling variants against a comparison of all words with all."""

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerline.llm import spelling


def one_edit(a, b):
    """Whether one inserted, deleted or replaced code point makes one word of the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{word}".encode())
                if h % 199 == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute_variants(counts, times=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = top if top is not None and counts[top] >= times * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def found_variants(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def edited(rnd, word, letters):
    at = rnd.randrange(len(word))
    return rnd.choice([word[:at] + word[at + 1 :], word[:at] + rnd.choice(letters) + word[at + rnd.randrange(2) :]])


def vocabulary(seed, n, letters="abcdé"):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(6, 10))) for _ in range(n)}
    for word in sorted(words):
        for _ in range(rnd.randrange(4)):
            words.add(edited(rnd, word, letters))
    return {w: 5 ** rnd.randrange(6) * rnd.randrange(1, 4) for w in sorted(words) if w}


@pytest.fixture
def table(spark):
    return lambda counts: spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_variants_match_brute_force(table, seed):
    counts = vocabulary(seed, 150)
    assert found_variants(spelling.variants(table(counts))) == brute_variants(counts)


def test_large_groups_are_cut_and_lose_nothing(table, monkeypatch):
    """One first half and one last half that most words share, in slices of some words, blocks of fewer."""
    monkeypatch.setattr(spelling, "SLICE", 16)
    monkeypatch.setattr(spelling, "BLOCK", 8)
    rnd = random.Random(8)
    counts = {"abcabc" + "".join(rnd.choice("xyz") for _ in range(rnd.randrange(3, 5))): rnd.randrange(5, 500) for _ in range(200)}
    counts |= {"".join(rnd.choice("xyz") for _ in range(4)) + "qrstu": rnd.randrange(5, 500) for _ in range(60)}
    pairs = spelling.near_pairs(table(counts)).collect()
    wanted = sorted((a, counts[a], b, counts[b]) for a in counts for b in counts if one_edit(a, b))
    assert sorted(tuple(p) for p in pairs) == wanted


def test_ties_any_letters_and_very_long_words(table):
    long = "x" * 5000
    counts = {"colour": 9, "color": 9, "colours": 45, "coloure": 45, long: 5, long + "y": 25, "漢字漢字漢字": 6, "漢字漢字漢": 30, "\U0001f600bc": 1}
    assert found_variants(spelling.variants(table(counts))) == brute_variants(counts)


def test_chains_of_forms_end_at_one_root(table):
    words = ["aaaaaa" + "b" * i for i in range(12)]
    counts = {w: 5**i for i, w in enumerate(words)}
    assert {r.root for r in spelling.variants(table(counts)).collect()} == {words[-1]}


def test_query_rows(spark, docs, tmp_path):
    rnd = random.Random(6)
    counts = vocabulary(11, 60, "aBcÀÿ×")
    pool = [w for w, n in counts.items() for _ in range(min(n, 90))]
    rows = [(i, rnd.choice([" ", "1", "\n", "ŕ", "Ã "]).join(rnd.choices(pool, k=rnd.randrange(80)))) for i in range(400)]
    rows += [(None, "Abcabca abcabca " * 20), (-3, None), (5, ""), (6, rows[6][1]), (6, rows[6][1])]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    words = brute_words(rows)
    assert any(zlib.crc32(f"{i}:{w}".encode()) % 199 == 0 for i in range(400) for w in words)
    assert found_variants(spelling.op11_spelling(spark, str(tmp_path))) == brute_variants(words)


def test_hard_cases_and_small_tables(spark, hard, empty, tmp_path, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 4)
    monkeypatch.setattr(spelling, "CHUNK", 50)
    hard.write.parquet(f"{tmp_path}/documents.parquet")
    words = brute_words([(r.doc_id, r.text) for r in hard.collect()])
    assert found_variants(spelling.op11_spelling(spark, str(tmp_path))) == brute_variants(words)
    assert spelling.variants(spelling.word_counts(empty)).collect() == []
