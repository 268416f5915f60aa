"""Quality rules, quality model, URL filter, decontamination, mixing, token counts and sharding."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import (
    decontaminate,
    mixing,
    quality_model,
    quality_rules,
    sharding,
    token_counts,
    url_filter,
)


def brute_counts(text):
    text = text or ""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.encode().split()]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_counts_match_brute_force(docs, hard):
    rnd = random.Random(2)
    rows = [
        (i, rnd.choice(["\n", " "]).join(rnd.choice(["a", "be", "#x", "<é>", "漢"]) for _ in range(rnd.randrange(60))))
        for i in range(60)
    ]
    for frame in (docs(rows), hard.where("doc_id is null or doc_id <> 7").select("doc_id", "text", "lang", "source")):
        got = quality_rules.quality_report(frame)
        expected = sorted((r.doc_id, *brute_counts(r.text)) for r in frame.where("doc_id is not null").collect())
        assert sorted(tuple(r)[:6] for r in got.where("doc_id is not null").collect()) == expected
        for r in got.collect():
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert not (r.base_failed and r.kept)


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(n))


def test_thresholds_follow_the_source(docs):
    """Text full of symbols is rejected among prose, and kept where the whole source is so."""
    rnd = random.Random(4)
    marked = lambda: " ".join(w + "##" for w in prose(rnd, 60).split())
    rows = [(i, prose(rnd, 60), "en", "prose") for i in range(300)] + [(1000 + i, marked(), "en", "prose") for i in range(9)]
    rows += [(2000 + i, marked(), "en", "code") for i in range(300)]
    kept = {r.doc_id for r in quality_rules.keep_good(docs(rows)).collect()}
    assert kept == {*range(300), *range(2000, 2300)}


def test_a_poor_third_of_a_source_is_rejected(docs):
    """35 % of a hot source's rows are poor in one measure each; the others are kept, as is a source that is all alike."""
    rnd = random.Random(14)
    poor = [
        lambda: " ".join(w + "##" for w in prose(rnd, 60).split()),
        lambda: prose(rnd, 60).upper(),
        lambda: " ".join(w + "!" for w in prose(rnd, 60).split()),
        lambda: " ".join(w * 9 for w in prose(rnd, 60).split()),
        lambda: " ".join(f"{w} {w}" for w in prose(rnd, 30).split()),
    ]
    for make in poor:
        rows = [(i, prose(rnd, 60), "en", "hot") for i in range(260)] + [(1000 + i, make(), "en", "hot") for i in range(140)]
        rows += [(2000 + i, make(), "en", "alike") for i in range(220)]
        kept = {r.doc_id for r in quality_rules.keep_good(docs(rows)).collect()}
        assert kept == {*range(260), *range(2000, 2220)}


def test_fences_are_set_by_the_data(spark):
    """Over half of all fences lie where the sketches put them, not where the bound for poor languages cuts them off."""
    rules = quality_rules.Rules()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counted = quality_rules.stored(quality_rules.with_counts(docs, "counts"), "test-counts")
    sketch = quality_rules.stored(quality_rules.sketches(counted, "counts", rules), "test-sketch")
    found = quality_rules.fences(sketch, rules).collect()
    cut = [r.high_cut for r in found] + [r.low_cut for r in found if r.measure == "word_length"]
    assert len(cut) > 500 and sum(cut) < len(cut) / 2
    most = {m.name: m.most for m in quality_rules.MEASURES}
    assert len({(r.measure, r.high) for r in found}) > len(most)  # groups differ


def test_a_fence_follows_the_spread_of_its_own_group(docs):
    """A source of widely varying symbols keeps its upper half; one poor source does not move the language's tail."""
    rnd = random.Random(21)
    code = lambda k: " ".join(w + "#" * (i < k) for i, w in enumerate(prose(rnd, 60).split()))
    rows = [(i, code(rnd.randrange(10, 50)), "en", "code") for i in range(250)]
    rows += [(1000 + i, prose(rnd, 60), "en", f"s{i % 40}") for i in range(800)]
    rows += [(3000 + i, code(58), "en", "s7") for i in range(8)]
    kept = {r.doc_id for r in quality_rules.keep_good(docs(rows)).collect()}
    assert kept == {*range(250), *range(1000, 1800)}


def test_quality_edge_cases(hard, empty):
    assert quality_rules.keep_good(hard).columns == hard.columns
    assert quality_rules.quality_report(hard).count() == hard.count()
    assert quality_rules.quality_report(empty).collect() == []
    assert quality_rules.keep_good(empty).collect() == []


def test_quality_model_learns_and_scores_unseen_rows(spark, docs):
    rnd = random.Random(6)
    good = lambda: " ".join(rnd.choice("the old river runs by green hills and small towns".split()) for _ in range(40))
    poor = lambda: " ".join(rnd.choice("buy cheap pills win cash now click here the and".split()) for _ in range(40))
    rows = [(i, good() if i % 2 else poor()) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    scored = quality_model.quality_scores(docs(rows), labels).collect()
    assert len(scored) == 400
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3) == r.doc_id % 2


def test_quality_model_does_not_see_held_out_labels(spark, docs):
    rows = [(i, f"word{i % 7} text") for i in range(60)]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    frames = [[(i, i % 2 if i not in held else flip) for i in range(60)] for flip in (0, 1)]
    a, b = (
        sorted((r.doc_id, r.score) for r in quality_model.quality_scores(docs(rows), spark.createDataFrame(f, "doc_id long, quality int")).collect())
        for f in frames
    )
    assert a == b


def test_quality_model_edge_cases(spark, hard, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (8, 0)], "doc_id long, quality int")
    scored = quality_model.quality_scores(hard, labels).collect()
    assert len(scored) == hard.count() and all(0 <= r.score <= 1 for r in scored)
    none = quality_model.quality_scores(hard, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_model.quality_scores(empty, labels).collect() == []


def test_tokens_of_features():
    raw = np.frombuffer("Ab-c  c! c!".encode(), np.uint8)
    buckets, doc = quality_model.features(raw, np.array([0, 4, len(raw)]), 18)
    # Ab - c | c ! c !: seven tokens, two and three pairs, and two repeats with one token between.
    assert Counter(doc.tolist()) == {0: 3 + 2, 1: 4 + 3 + 2}
    assert (buckets == 1).sum() == 2


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group().translate({c: c + 32 for c in range(65, 91)})
        path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    best = None
    for rule in url_filter.RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.place) > len(best.place):
                best = rule
    return host, path, best


URLS = [
    None, "", "no scheme", "://", "http://", "http://A.ORG", "http://a.ORG/x?y#z", "http://example.org/es/1",
    "https://b.Example.org/en/12", "http://example.org/en/2", "http://badexample.org/es/1", "http://x.com/fr/",
    "http://x.com/frx", "http://x.com/de/1?a=1&b=2", "http://com/de/", "http://org", "http://ÄB.org/é#a/b",
    "http://x.net/en/1", "a://b://c/d", "http://x.com?q=/fr/", "http://x.com/de/\nline", "http://" + "a" * 50_000 + ".org/" + "b/" * 1000,
]


def test_rules_hosts_and_paths(spark):
    urls = URLS + [f"http://n{i}.example.{t}/{p}/{i}" for i in range(40) for t in ("net", "com", "org") for p in ("fr", "de", "en")]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = {r.page_id: r for r in url_filter.verdicts(pages).collect()}
    for i, url in enumerate(urls):
        host, path, rule = brute_rule(url)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule and rule.place), url
        assert found[i].verdict in ("allow", "block")
        if rule:
            assert found[i].verdict == ("allow" if rule.allow else "block")
    # The trees go by what the labelled URLs show: /de/ is blocked and /fr/ allowed under com.
    assert {found[i].verdict for i, u in enumerate(urls) if u and u.startswith("http://n") and ".net/fr/" in u} == {"allow"}


def test_urls_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://x.net/"), (2, None), (2, None)], "page_id long, url string")
    assert [r.verdict for r in url_filter.verdicts(pages).collect()] == ["allow"] * 3
    blocked = spark.createDataFrame([(1, "http://x.net/"), (2, "http://x.com/de/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.verdicts(blocked).collect()] == ["block"] * 2
    assert url_filter.verdicts(pages.limit(0)).collect() == []


def test_leaks_are_found_with_substitutions_and_clean_texts_are_not(spark, docs):
    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("abcdefghijé") for _ in range(5)) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(30)) for i in range(20)] + [(50, text(6)), (51, text(3)), (52, None), (53, "")]
    rows = [(i, text(200)) for i in range(100)]
    planted = {}
    for i in range(40):
        item, passage = rnd.choice(items[:20])
        words = passage.split()
        for at in rnd.sample(range(30), 3):  # one in ten words is another
            words[at] = "zzz"
        shown = " ".join(w.upper() + rnd.choice([",", "", "."]) for w in words)
        planted[200 + i] = item
        rows.append((200 + i, f"{text(40)} {shown}\n{text(20)}"))
    rows += [(300, f"{text(9)} {items[20][1]} {text(9)}"), (301, items[21][1]), (302, None), (303, "")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(1))
    keyed = docs(rows).select(F.col("doc_id").alias("key"), "text")
    found = {(r.key, r.item_id) for r in decontaminate.overlaps(keyed, bench).collect()}
    assert found == {*planted.items(), (300, 50)}
    kept = {r.doc_id for r in decontaminate.without_leaks(docs(rows), bench).collect()}
    assert kept == {i for i, _ in rows} - {*planted, 300}


def accepted_patterns(n):
    """Which tokens are equal, for all that the rule accepts of an item of ``n`` tokens, whole or cut off by a document's edge."""
    least = -(-3 * n // 4)
    for length in range(least, n + 1):
        for other in itertools.combinations(range(length), length - least):
            yield [i not in other for i in range(length)]


def test_every_accepted_pattern_holds_a_mask():
    for n in range(5, 17):
        masks = [[i for i, c in enumerate(m) if c == "1"] for _, size, m in decontaminate.all_masks() if size == decontaminate.size_class(n)]
        for equal in accepted_patterns(n):
            places = [(mask, at) for mask in masks for at in range(len(equal) - mask[-1])]
            assert any(all(equal[at + i] for i in mask) for mask, at in places), (n, equal)


def test_every_accepted_pattern_is_reported(spark, docs):
    """Also those cut off by the document's start or end, which are a part of the item."""
    items = [(n, [f"t{n}x{i}" for i in range(n)]) for n in range(5, 17)]
    rows, expected = [], set()
    for n, words in items:
        for equal in accepted_patterns(n):
            own = [w if same else f"o{len(rows)}x{i}" for i, (w, same) in enumerate(zip(words, equal))]
            around = ["before"] * 40, ["after"] * 40
            # A whole item stands amid other words; a part of it starts the document, as the item's end.
            shown = [*around[0], *own, *around[1]] if len(own) == n else own + around[1]
            if len(own) < n:
                shown = [w if same else f"o{len(rows)}x{i}" for i, (w, same) in enumerate(zip(words[n - len(own) :], equal))] + around[1]
            rows.append((len(rows), " ".join(shown)))
            expected.add((len(rows) - 1, n))
    bench = spark.createDataFrame([(n, " ".join(words)) for n, words in items], "item_id long, text string")
    found = {(r.key, r.item_id) for r in decontaminate.overlaps(docs(rows).select(F.col("doc_id").alias("key"), "text"), bench).collect()}
    assert expected - found == set() and found == expected


def test_parts_of_a_longer_item_at_a_documents_edge(spark, docs):
    item = [f"w{i}" for i in range(40)]
    part = lambda a, b: " ".join(item[a:b])
    rows = [(1, part(10, 22)), (2, part(10, 25)), (3, "x " * 50 + part(0, 12)), (4, part(28, 40) + " y" * 50)]
    rows += [(5, part(10, 21)), (6, "x " * 50 + part(0, 11)), (7, part(29, 40) + " y" * 50), (8, "x " * 50 + part(0, 12) + " y" * 50)]
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    found = decontaminate.overlaps(docs(rows).select(F.col("doc_id").alias("key"), "text"), bench).collect()
    assert {r.key: r.n_equal for r in found} == {1: 12, 2: 15, 3: 12, 4: 12, 8: 12}


def test_tokens_beyond_ascii(spark, docs):
    han = "天地玄黄宇宙洪荒日月盈昃辰宿列張寒來暑往"
    words = [f"höhe{i}" for i in range(20)]
    bench = spark.createDataFrame([(0, han), (1, " ".join(words))], "item_id long, text string")
    rows = [(0, "話" * 30 + han[:15] + "、" + han[15:] + "話" * 30), (1, "”“ — ".join(f"“{w.upper()}”" for w in words)), (2, "話" * 60)]
    found = decontaminate.overlaps(docs(rows).select(F.col("doc_id").alias("key"), "text"), bench).collect()
    assert {(r.key, r.item_id) for r in found} == {(0, 0), (1, 1)}


def test_decontamination_edge_cases(spark, hard, empty):
    bench = spark.createDataFrame([(1, "One two three four five SIX seven eight nine ten"), (None, "one two three four five"), (2, None)], "item_id long, text string")
    kept = decontaminate.without_leaks(hard, bench)
    assert kept.columns == hard.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 5, 6, 7]
    assert decontaminate.without_leaks(empty, bench).collect() == []
    assert decontaminate.without_leaks(hard, bench.limit(0)).count() == hard.count()


def test_raked_weights_have_the_target_margins(spark):
    rnd = random.Random(3)
    cells = [(s, l, t, 1, rnd.randrange(1, 90)) for s in "abc" for l in ("x", "y", None) for t in "pq" if rnd.random() < 0.9]
    found = spark.createDataFrame(cells, "source string, lang string, topic string, docs long, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 1, "y": 2, None: 1}, "topic": 0.5}
    out = mixing.raked(found, mixing.Mix(targets=targets, sweeps=200)).collect()
    for d, shares in (("source", targets["source"]), ("lang", {"x": 0.25, "y": 0.5, None: 0.25})):
        for value, share in shares.items():
            assert sum(r.weight for r in out if r[d] == value) == pytest.approx(share, abs=1e-9)
    # Raked weights are the counts times one factor per source, language and topic.
    by = {(r.source, r.lang, r.topic): np.log(r.weight / r.tokens) for r in out}
    for s in "ab":
        for l in ("x", "y"):
            corners = [(s, l, "p"), (s, l, "q"), ("c", l, "p"), ("c", l, "q")]
            if all(c in by for c in corners):
                assert by[corners[0]] - by[corners[1]] == pytest.approx(by[corners[2]] - by[corners[3]])


def test_sample_has_the_target_weights(docs):
    rnd = random.Random(1)
    rows = [(i, "w " * rnd.randrange(1, 40), rnd.choice(["en", "en", "de"]), rnd.choice("aaab")) for i in range(6000)]
    mix = mixing.Mix(targets={"source": {"a": 0.4, "b": 0.6}, "lang": {"en": 0.5, "de": 0.5}, "topic": 1.0})
    sample = mixing.mixed_sample(docs(rows), mix).collect()
    tokens = Counter()
    for r in sample:
        n = len(r.text.split())
        tokens.update({r.source: n, r.lang: n})
    total = tokens["a"] + tokens["b"]
    assert tokens["a"] / total == pytest.approx(0.4, abs=0.04)
    assert tokens["de"] / total == pytest.approx(0.5, abs=0.04)
    chances = [r.probability for r in mixing.probabilities(docs(rows), mix).collect()]
    assert max(chances) == pytest.approx(1.0) and min(chances) > 0


def test_values_without_a_target_are_left_out(docs):
    rows = [(i, "some words here", "en", "ab"[i % 2]) for i in range(20)]
    mix = mixing.Mix(targets={"source": {"a": 1.0, "none": 5.0}, "lang": 1.0, "topic": 1.0})
    assert {r.source for r in mixing.mixed_sample(docs(rows), mix).collect()} == {"a"}


def kept_share(frame, mix):
    """Expected share of the tokens in the sample, and the tokens by source."""
    found = mixing.cells(frame).collect()
    p = {tuple(r[d] for d in mixing.DIMENSIONS): r.probability for r in mixing.probabilities(frame, mix).collect()}
    assert all(0 <= x <= 1 for x in p.values())
    by = Counter()
    for r in found:
        by[r.source] += r.tokens * p[r.source, r.lang, r.topic]
    return sum(by.values()) / sum(r.tokens for r in found), by


def test_a_source_of_one_document_does_not_shrink_the_sample(docs):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randrange(20, 90), rnd.choice(["en", "de", None]), rnd.choice("aaab")) for i in range(900)]
    tiny = [(1000, "ten words " * 5, "en", "tiny")]
    mix = mixing.Mix(least_kept=0.6)
    before, _ = kept_share(docs(rows), mix)
    after, by = kept_share(docs(rows + tiny), mix)
    assert kept_share(docs(rows + tiny), mixing.Mix())[0] < 0.4
    assert before >= 0.6 - 1e-6 and after >= 0.6 - 1e-6
    # The tiny source is kept whole; the others have their targets' proportions.
    assert by["tiny"] == pytest.approx(10)
    words_of = Counter()
    for _, text, _, source in rows:
        words_of[source] += len(text.split())
    assert by["a"] / by["b"] == pytest.approx((words_of["a"] / words_of["b"]) ** 0.8, rel=1e-4)


def test_one_document_changes_the_kept_share_by_less_than_a_hundredth(docs):
    """Under the rule of the query and of the pipeline; and sweeps that do not get there are told of."""
    rnd = random.Random(15)
    rows = [(i, "w " * rnd.randrange(20, 90), rnd.choice(["en", "de", "fr"]), rnd.choice("aaabbc")) for i in range(900)]
    before, _ = kept_share(docs(rows), mixing.PRODUCTION)
    after, by = kept_share(docs([*rows, (1000, "ten words " * 5, "xx", "tiny")]), mixing.PRODUCTION)
    assert abs(before - after) < 0.01 and by["tiny"] == pytest.approx(10)
    targets = {"source": {"a": 0.1, "b": 0.1, "c": 0.8}, "lang": {"en": 0.1, "de": 0.8, "fr": 0.1}, "topic": 1.0}
    with pytest.warns(UserWarning, match="still off"):
        kept_share(docs(rows[:60]), mixing.Mix(targets=targets, sweeps=1, least_kept=0.9))


def test_bounded_cells_meet_every_margin_that_can_be_met(docs):
    rows = [(i, "w " * 50, "en", "a") for i in range(900)] + [(1000 + i, "w " * 50, "de", "b") for i in range(60)]
    rows += [(2000 + i, "w " * 50, "de", "a") for i in range(240)] + [(3000 + i, "w " * 5, "en", f"t{i}") for i in range(40)]
    rows += [(4000, None, "en", "a"), (4001, "w", None, None)]
    mix = mixing.Mix(targets={"source": 0.8, "lang": {"en": 0.5, "de": 0.5, None: 0.0}, "topic": 1.0}, least_kept=0.4)
    share, by = kept_share(docs(rows), mix)
    assert share == pytest.approx(0.4, abs=1e-4) and by[None] == 0
    assert by["t0"] == pytest.approx(5) and by["a"] > by["b"] > 0


def test_mixing_edge_cases(hard, empty):
    report = mixing.mix_report(hard).collect()
    assert len(report) == hard.count()
    assert {(r.doc_id, r.probability, r.sampled) for r in report if r.doc_id in (2, 4)} >= {(2, 1.0, True)}
    assert mixing.mixed_sample(hard).columns == hard.columns
    twice = [r.sampled for r in report if r.doc_id == 1]
    assert len(twice) == 2 and len(set(twice)) == 1
    assert mixing.mix_report(empty).collect() == []
    assert mixing.mixed_sample(empty).collect() == []


@pytest.fixture(scope="module")
def vocabulary_file():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


TRICKY = [
    None, "", " \n\t", "it's we'LL they've 'tis rock'n'roll ''s '", "a,b;c!?d...e$$$f", "12345 3.14 ½ ²x",
    "<|endoftext|> x<|startoftext|>y <| <|ENDOFTEXT|> a<|endoftext|>,b", "Éé È ñ ß Σας İI ǅ", "e\u0301 =\u0338 a\u0300b",
    "漢字かな 한국어 عربى", "\U0001f600\U0001f1e9\U0001f1ea x\u200dy", "a\u00a0b\u3000c\u2028d\x1ce\x85f", "A" * 5000, "ab," * 3000, "\x00a\x01b",
]


@pytest.mark.parametrize("head", [0, 3, 100_000])
def test_token_counts_match_the_library(docs, vocabulary_file, head):
    from tokenizers import Tokenizer

    rnd = random.Random(5)
    alphabet = "abzAZ019 '',.!<|>-\n\té漢$ "
    rows = list(enumerate(TRICKY + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80))) for _ in range(300)]))
    library = Tokenizer.from_file(vocabulary_file)
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(tuple(r) for r in token_counts.token_counts(docs(rows), vocabulary_file, head).collect()) == expected


def test_token_count_edge_cases(hard, empty, vocabulary_file):
    out = token_counts.token_counts(hard, vocabulary_file).collect()
    assert len(out) == hard.count()
    assert {(r.n_bytes, r.n_tokens) for r in out if r.doc_id in (2, 3)} == {(0, 0)}
    assert len({r.n_tokens for r in out if r.doc_id in (1, 8)}) == 1
    assert token_counts.token_counts(empty, vocabulary_file).collect() == []


def brute_best_fit(sizes, capacity):
    rooms, bins = [], []
    for size in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fits:
            room, i = min(fits)
        else:
            room, i = capacity, len(rooms)
            rooms.append(capacity)
        rooms[i] = room - size
        bins.append(i)
    return bins


def test_best_fit_takes_the_tightest_bin():
    rnd = random.Random(7)
    for _ in range(60):
        sizes = sorted((rnd.randrange(1, 50) for _ in range(rnd.randrange(60))), reverse=True)
        assert sharding.best_fit(sizes, 60) == brute_best_fit(sizes, 60)


def test_pack_finds_a_small_capacity():
    rnd = random.Random(8)
    sizes = sorted((rnd.randrange(1, 500) for _ in range(900)), reverse=True)
    load = Counter()
    for size, b in zip(sizes, sharding.pack(sizes, 24)):
        load[b] += size
    assert set(load) == set(range(24))
    assert max(load.values()) <= 1.005 * sum(sizes) / 24
    assert sharding.pack([100, 1, 1], 3) == [0, 1, 2]
    assert sharding.pack([100, 50, 1, 1, 1, 1], 4) == [0, 1, 2, 2, 3, 3]
    assert sharding.pack([], 24) == []


def test_shards_are_whole_even_and_gapless(docs):
    rnd = random.Random(9)
    texts = [prose(rnd, rnd.randrange(1, 50)) for _ in range(500)]
    rows = [(i, rnd.choice(texts[:400])) for i in range(1500)] + [(5000 + i, "the hot one") for i in range(1200)]
    out = sharding.sharded(docs(rows)).collect()
    by_text, load, slots = {}, Counter(), {}
    text_of = dict(rows)
    for r in out:
        assert r["size"] == len(text_of[r.doc_id].encode()) + 8
        assert r.text_crc32 == zlib.crc32(text_of[r.doc_id].encode())
        assert by_text.setdefault(text_of[r.doc_id], r.shard) == r.shard
        load[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(out) == len(rows) and set(load) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    others = sorted(load.values())[:-1]  # the hot group fills a shard alone
    assert sum(others) == sum(load.values()) - 1200 * 19
    assert max(others) - min(others) <= 0.05 * max(others)


def test_written_shards_hold_every_document(spark, hard, tmp_path):
    sharding.write_shards(hard, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == hard.count()


def test_sharding_edge_cases(hard, empty):
    out = sharding.sharded(hard).collect()
    assert len(out) == hard.count()
    assert {(r["size"], r.text_crc32) for r in out if r.doc_id in (2, 3)} == {(8, 0)}
    assert len({r.shard for r in out if r.doc_id == 1}) == 1
    assert sharding.sharded(empty).collect() == []
