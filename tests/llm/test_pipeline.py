"""The pipeline over small tables: its stages one by one, and what is left at the end."""

import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import pyarrow as pa
import pytest

from ledgerline.llm import mixing, quality_rules
from tests.llm.test_dedup import brute_components


@pytest.fixture
def tables(spark, docs, tmp_path):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(30)) for i in range(5)]
    good = [(i, text(120), "en", f"s{i % 3}") for i in range(60)]
    copies = [(100 + i, good[i][1], "en", "s0") for i in range(10)]
    leaks = [(200 + i, f"{text(60)} {items[i][1]} {text(30)}", "en", "s1") for i in range(5)]
    short = [(300 + i, text(5), "en", "s1") for i in range(5)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs(good + copies + leaks + short).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_stages_keep_what_they_should(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, ids = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, tables), name)
        assert docs.columns == columns or name == "sharding"
        ids.append({r.doc_id for r in docs.collect()})
    good, copies, leaks = set(range(60)), set(range(100, 110)), set(range(200, 205))
    assert ids[0] == good | copies | leaks
    assert ids[1] == good | leaks
    assert ids[2] == good
    assert ids[3] <= good and len(ids[3]) > 20
    assert ids[4] == ids[3]


def test_run_gives_the_last_stage(spark, tables):
    out = corpus_pipeline.run(spark, tables).collect()
    assert {r.shard for r in out} <= set(range(24))
    assert len({r.doc_id for r in out}) == len(out) > 20


def test_an_empty_table_goes_through(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, tables), name)
    assert docs.count() == 0


@pytest.fixture
def hard_tables(spark, docs, tmp_path):
    """Good texts of three sources and two languages, and what each stage has to see: nulls, a very long text, repeated rows,
    near copies, passages of the benchmark with substitutions, a source of one document, an extra column with a clashing name."""
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(30)) for i in range(4)] + [(4, text(7)), (5, None), (None, text(20))]
    rows = [(i, text(rnd.randrange(60, 140)), rnd.choice(["en", "en", "de"]), f"s{i % 3}") for i in range(90)]
    rows += [(100 + i, rows[i][1].replace(" a", " A"), "en", "s0") for i in range(12)]
    rows += [rows[5], rows[5], rows[7], (None, text(80), "en", "s1"), (None, rows[9][1], "de", None), (150, text(60), None, "alone")]
    rows += [(160, None, None, None), (161, "", "en", "s0"), (162, text(6), "en", "s0"), (163, text(12000), "en", "s1")]
    rows += [(170, "ab cd ef gh " * 40, "en", "s2"), (171, text(60).upper(), "en", "s2"), (172, " ".join(w + "##" for w in text(60).split()), "en", "s1")]
    for i in range(6):
        passage = items[i % 4][1].split()
        for at in rnd.sample(range(30), 3):
            passage[at] = "zz"
        rows.append((200 + i, f"{text(40)} {' '.join(passage)}, {text(20)}", "en", f"s{i % 3}"))
    rows += [(210, f"{text(50)} {items[4][1].upper()} {text(30)}", "de", "s1"), (211, f"{text(50)} {items[6][1]}", "de", "s1")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    from pyspark.sql import functions as F

    docs(rows).withColumns({"kept": F.lit("other"), "Probability": F.lit(1)}).write.parquet(f"{tmp_path}/documents.parquet")
    full = [(d, t, lang, source, len(t or ""), "other", 1) for d, t, lang, source in rows]
    return str(tmp_path), full, items


def by_sql(query, rows, columns):
    """A query's SQL over rows as the table ``documents``."""
    names = ("doc_id", "text", "lang", "source", "n_chars")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
    con = duckdb.connect()
    con.register("documents", pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds))}))
    return con.sql(f"select {columns} from ({query})").fetchall()


def shares_a_passage(text, items):
    """Whether 16 tokens side by side with an item (all of a shorter one, or what an edge leaves) have enough equal ones."""
    ours = re.findall(r"[a-z0-9]+", text.lower())
    for _, item in items:
        theirs = re.findall(r"[a-z0-9]+", (item or "").lower())
        if len(theirs) < 5:
            continue
        least = -(-3 * min(16, len(theirs)) // 4)
        for d in range(-len(theirs) + 1, len(ours)):
            same = [a == b for a, b in zip(ours[max(d, 0) :], theirs[max(-d, 0) :])]
            width = min(16, len(theirs), len(same))
            if sum(same) >= least and any(sum(same[i : i + width]) >= least for i in range(len(same) - width + 1)):
                return True
    return False


def plain_stages(rows, items):
    """The rows that each stage leaves, by SQL or plain Python."""
    # The SQL takes ids to be unique, and the rules do not look at them.
    numbered = [(i, *r[1:]) for i, r in enumerate(rows)]
    good = {i for i, k in by_sql(quality_rules.ORACLE["op9_quality_rules"], numbered, "doc_id, kept") if k}
    rows = [r for i, r in enumerate(rows) if i in good]
    yield rows
    # One of each group: the smallest id; a group without ids is told by its fingerprint.
    groups = {}
    components = {(d, p): c for d, p, c in brute_components([r[:2] for r in rows])}
    prints = [p for r in rows for d, p, _ in brute_components([r[:2]])]
    for r, p in zip(rows, prints):
        groups.setdefault(components[r[0], p], []).append(r)
    rows = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for c, g in groups.items() if c is not None] + groups.get(None, [])
    yield rows
    rows = [r for r in rows if not shares_a_passage(r[1], items)]
    yield rows
    sampled = {d for d, s in by_sql(mixing.ORACLE["op1_mixing"], rows, "doc_id, sampled") if s}
    rows = [r for r in rows if r[0] in sampled]
    yield rows


def test_stages_and_run_match_a_plain_version(spark, hard_tables):
    path, rows, items = hard_tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, sizes = docs.columns, [len(rows)]
    by = lambda found: sorted((tuple(r) for r in found), key=repr)
    for (name, stage), expected in zip(corpus_pipeline.STAGES, plain_stages(rows, items)):
        docs = corpus_pipeline.stored(stage(spark, docs, path), name)
        assert docs.columns == columns
        assert by(docs.collect()) == by(expected), name
        sizes.append(len(expected))
    assert all(a > b for a, b in zip(sizes, sizes[1:])) and sizes[-1] > 20
    out = corpus_pipeline.run(spark, path).collect()
    told = lambda d, t: (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "bytes")
    assert by((r.doc_id, r["size"], r.text_crc32, r.law) for r in out) == by(told(r[0], r[1]) for r in expected)
    load, slots = Counter(), {}
    for r in out:
        load[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(load) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
