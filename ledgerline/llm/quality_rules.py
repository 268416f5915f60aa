"""Quality rules with adaptive thresholds.

Every document gets counts of simple signs of poor text. Fixed rules (too few words, too much of the
text repeated) come first. All other limits come from the data: for each language and source a
mergeable quantile sketch of every measure is kept, and a document is rejected if one of its measures lies
beyond a fence of its group.

The sketch of a measure is a histogram over values cut to three significant digits, so a quantile is
off by 1 % at most, the sketch of a group has a bounded number of buckets, and sketches merge by adding
counts. A fence lies at a distance from the group's median that is the larger of two: some times the spread of the
half of the group on the median's other side, which poor rows cannot move as long as they are fewer than half; and
the distance of a far quantile of the language, in which every source counts alike, so that one large source cannot
move it much. The second one goes no farther than ``most``, for languages in which many sources are poor. A count
may be some occurrences beyond its fence, as a short text with one of them is not a poor one.
Groups with few documents use the merged sketch of their language, or that of all documents.

Defined results: a null text counts as empty and fails the fixed rule; null languages and sources form
groups of their own; repeated rows are judged alike, row by row; very long texts are counted whole; other
columns, whatever their names, play no part and go through ``keep_good`` as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import SPACES, free_name, stored, table, whole, words

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8


@dataclass(frozen=True)
class Measure:
    """``scale * over / under``, cut to a whole number; ``most`` is how far from the median the language may put the
    fence, ``slack`` how many occurrences beyond it are let pass; ``low`` also sets a lower fence."""

    name: str
    over: str
    under: str
    scale: int
    most: int
    slack: int = 2
    low: bool = False


MEASURES = (
    Measure("symbols", "n_symbols", "n_words", 1000, 150),
    Measure("upper", "n_upper", "word_chars", 1000, 200),
    Measure("marks", "n_marks", "n_words", 1000, 200),
    Measure("dup_lines", "n_dup_lines", "n_lines", 1000, 500),
    Measure("repeats", "n_repeat_words", "n_words", 1000, 280),
    Measure("echoes", "n_echoes", "n_words", 1000, 200),
    Measure("word_length", "word_chars", "n_words", 100, 250, slack=0, low=True),
)


@dataclass(frozen=True)
class Rules:
    """``spread`` times the distance between median and quartile is the least distance of a fence; one in ``rare``
    documents of a language lies beyond its far quantiles; groups of fewer than ``min_group`` documents use wider
    sketches."""

    min_words: int = 20
    max_repeat_percent: int = 30
    spread: int = 10
    rare: int = 200
    min_group: int = 200
    measures: tuple[Measure, ...] = MEASURES


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def with_counts(docs: DataFrame, name: str) -> DataFrame:
    """Adds a struct column ``name`` with the counts of each document's text."""
    text = whole("text")
    keep = [F.col(c) for c in docs.columns]
    split, hashed, ordered, starts = (
        free_name(docs, f"{name}_{part}") for part in ("words", "windows", "sorted", "starts")
    )
    df = docs.select(*keep, words(text).alias(split))
    # A window is a repeat if its 96 bits of hash are found twice in the text. The second hash is only
    # computed for texts in which the first is found twice.
    windows = F.transform(
        F.sequence(F.lit(1), F.size(split) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(F.col(split), i, WINDOW)),
    )
    none = F.array().cast("array<bigint>")
    df = df.withColumn(hashed, F.when(F.size(split) >= WINDOW, windows).otherwise(none))
    both = F.transform(
        F.col(hashed),
        lambda h, i: F.struct(
            h.alias("h"), F.hash(F.slice(F.col(split), i + 1, WINDOW)).alias("g"), i.alias("i")
        ),
    )
    repeated = F.size(F.array_distinct(hashed)) < F.size(hashed)
    df = df.withColumn(
        ordered,
        F.when(repeated, F.sort_array(both)).otherwise(
            F.array().cast("array<struct<h:bigint,g:int,i:int>>")
        ),
    )
    pairs = F.zip_with(
        F.slice(ordered, 1, F.greatest(F.size(ordered) - 1, F.lit(0))),
        F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))),
        lambda a, b: F.when((a.h == b.h) & (a.g == b.g), F.array(a.i, b.i)),
    )
    df = df.withColumn(
        starts, F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    )
    steps = F.zip_with(
        F.slice(starts, 1, F.greatest(F.size(starts) - 1, F.lit(0))),
        F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.when(
        F.size(starts) > 0,
        F.lit(WINDOW) + F.aggregate(steps, F.lit(0), lambda total, step: total + step),
    ).otherwise(0)
    rest = F.greatest(F.size(split) - 1, F.lit(0))
    echoes = F.zip_with(F.slice(split, 1, rest), F.slice(split, 2, rest), lambda a, b: a == b)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    length = F.char_length(text)
    counts = {
        "n_words": F.size(split),
        "word_chars": F.char_length(F.regexp_replace(text, SPACES + "+", "")),
        "n_symbols": length - _without(text, SYMBOLS),
        "n_upper": length - _without(text, UPPER),
        "n_marks": length - _without(text, "!"),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered,
        "n_echoes": F.size(F.filter(echoes, lambda same: same)),
    }
    return df.select(*keep, F.struct(*[c.cast("long").alias(n) for n, c in counts.items()]).alias(name))


def base_failed(counts: str, rules: Rules) -> Column:
    n = F.col(f"{counts}.n_words")
    repeated = 100 * F.col(f"{counts}.n_repeat_words") > rules.max_repeat_percent * n
    return (n < rules.min_words) | repeated


def _value(counts: str, measure: Measure, slack: int = 0) -> Column:
    over = f"greatest({counts}.{measure.over} - {slack}, 0)"
    return F.expr(f"{measure.scale} * {over} div greatest({counts}.{measure.under}, 1)")


def _bucket(value: Column) -> Column:
    """Whole numbers cut to three significant digits."""
    unit = F.rpad(F.lit("1"), F.greatest(F.length(value.cast("string")) - 2, F.lit(1)), "0").cast("long")
    return value - F.pmod(value, unit)


def sketches(counted: DataFrame, counts: str, rules: Rules) -> DataFrame:
    """Rows in each bucket, by language, source and measure, of the documents that pass the fixed rules."""
    values = F.array(
        *[
            F.struct(F.lit(m.name).alias("measure"), _bucket(_value(counts, m)).alias("bucket"))
            for m in rules.measures
        ]
    )
    return (
        counted.where(~base_failed(counts, rules))
        .select("lang", "source", F.explode(values).alias("v"))
        .groupBy("lang", "source", F.col("v.measure").alias("measure"), F.col("v.bucket").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


#: What the buckets of one source sum to where every source counts alike.
_SHARES = 1_000_000


def _quartiles(sketch: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Documents, quartiles and median of each measure, by group."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumn("upto", 4 * upto).withColumn("total", F.sum("n").over(group))
    at = lambda k: F.min(F.when(F.col("upto") >= k * F.col("total"), F.col("bucket")))
    return ranked.groupBy(*keys, "measure").agg(
        F.struct(F.max("total").alias("docs"), at(1).alias("q1"), at(2).alias("q2"), at(3).alias("q3")).alias(prefix)
    )


def _tails(sketch: DataFrame, keys: list[str], rules: Rules, prefix: str) -> DataFrame:
    """The far quantiles of each measure, where every source of the group counts alike."""
    source = Window.partitionBy("lang", "source", "measure")
    share = F.floor(F.col("n") * _SHARES / F.sum("n").over(source)).cast("long")
    merged = sketch.withColumn("share", share).groupBy(*keys, "measure", "bucket").agg(F.sum("share").alias("share"))
    group = Window.partitionBy(*keys, "measure")
    upto = F.sum("share").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumn("upto", rules.rare * upto).withColumn("total", F.sum("share").over(group))
    at = lambda k: F.min(F.when(F.col("upto") >= k * F.col("total"), F.col("bucket")))
    return ranked.groupBy(*keys, "measure").agg(F.struct(at(1).alias("low"), at(rules.rare - 1).alias("high")).alias(prefix))


def fences(sketch: DataFrame, rules: Rules) -> DataFrame:
    """By language, source and measure, ``high`` and ``low`` and whether ``most`` set them, ``high_cut`` and ``low_cut``."""
    by_lang = _quartiles(sketch, ["lang"], "of_lang").join(_tails(sketch, ["lang"], rules, "lang_tail"), ["lang", "measure"])
    by_lang = by_lang.withColumnRenamed("lang", "lang_").withColumnRenamed("measure", "measure_")
    overall = _quartiles(sketch, [], "of_all").join(_tails(sketch, [], rules, "all_tail"), "measure")
    joined = (
        _quartiles(sketch, ["lang", "source"], "own")
        .join(by_lang, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("measure") == F.col("measure_")), "left")
        .join(overall, "measure", "left")
    )
    many = lambda group: F.col(f"{group}.docs") >= rules.min_group
    chosen = F.when(many("own"), F.col("own")).when(many("of_lang"), F.col("of_lang")).otherwise(F.col("of_all"))
    tail = F.when(many("of_lang"), F.col("lang_tail")).otherwise(F.col("all_tail"))
    most = F.when(F.lit(False), F.lit(0))
    for m in rules.measures:
        most = most.when(F.col("measure") == m.name, F.lit(m.most))
    far = joined.select("lang", "source", "measure", chosen.alias("q"), tail.alias("tail"), most.alias("most")).select(
        "lang", "source", "measure", "most", "q",
        (rules.spread * (F.col("q.q2") - F.col("q.q1"))).alias("above"),
        (rules.spread * (F.col("q.q3") - F.col("q.q2"))).alias("below"),
        (F.col("tail.high") - F.col("q.q2")).alias("far_above"),
        (F.col("q.q2") - F.col("tail.low")).alias("far_below"),
    )
    return far.select(
        "lang", "source", "measure",
        (F.col("q.q2") + F.greatest("above", F.least("far_above", "most"))).alias("high"),
        (F.col("q.q2") - F.greatest("below", F.least("far_below", "most"))).alias("low"),
        ((F.col("far_above") > F.col("most")) & (F.col("above") < F.col("most"))).alias("high_cut"),
        ((F.col("far_below") > F.col("most")) & (F.col("below") < F.col("most"))).alias("low_cut"),
    )


def thresholds(counted: DataFrame, counts: str, rules: Rules) -> DataFrame:
    """Fences for every language and source among ``counted``, one row each."""
    sketch = stored(sketches(counted, counts, rules), "quality-sketches")
    bounds = []
    for m in rules.measures:
        own = F.col("measure") == m.name
        bounds.append(F.max(F.when(own, F.col("high"))).alias(f"{m.name}_high"))
        if m.low:
            bounds.append(F.max(F.when(own, F.col("low"))).alias(f"{m.name}_low"))
    wide = fences(sketch, rules).groupBy("lang", "source").agg(F.struct(*bounds).alias("fence"))
    return stored(wide, "quality-thresholds")


def judged(counted: DataFrame, counts: str, limits: DataFrame, rules: Rules, name: str) -> DataFrame:
    """Adds the boolean ``name``: whether the document passes the fixed rules and its group's fences.

    A document without fences failed the fixed rules, as did all of its group.
    """
    lang, source, fence = (free_name(counted, n) for n in ("fence_lang", "fence_source", "fence"))
    limits = limits.select(F.col("lang").alias(lang), F.col("source").alias(source), F.col("fence").alias(fence))
    joined = counted.join(
        limits, F.col("lang").eqNullSafe(F.col(lang)) & F.col("source").eqNullSafe(F.col(source)), "left"
    )
    inside = F.lit(True)
    for m in rules.measures:
        inside = inside & (_value(counts, m, m.slack) <= F.col(f"{fence}.{m.name}_high"))
        if m.low:
            inside = inside & (_value(counts, m) >= F.col(f"{fence}.{m.name}_low"))
    # One expression: a condition on the counts alone would be pushed below the columns they come from,
    # and each of them would be worked out again wherever the condition names it.
    verdict = F.when(inside.isNull() | base_failed(counts, rules), F.lit(False)).otherwise(inside)
    return joined.select(*[counted[c] for c in counted.columns], verdict.alias(name))


def quality_report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document with its counts, whether a fixed rule failed, and whether it is kept."""
    counted = stored(
        with_counts(docs.select("doc_id", "text", "lang", "source"), "counts").drop("text"), "quality-counts"
    )
    verdicts = judged(counted, "counts", thresholds(counted, "counts", rules), rules, "kept")
    return verdicts.select(
        "doc_id",
        *[f"counts.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed("counts", rules).alias("base_failed"),
        "kept",
    )


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep, with the columns they came with."""
    counts, kept = free_name(docs, "quality_counts"), free_name(docs, "quality_kept")
    # Counting costs far more than writing, so the documents are kept beside their counts for the second pass.
    counted = stored(with_counts(docs, counts), "quality-counts")
    verdicts = judged(counted, counts, thresholds(counted, counts, rules), rules, kept)
    return verdicts.where(F.col(kept)).select(*docs.columns)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


_COUNTS_SQL = r"""
words as (
    select doc_id, lang, source, coalesce(text, '') as t,
        list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) as l
    from documents
),
windows as (
    select doc_id, i, list_slice(w, i, i + 7) as g
    from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from words where len(w) >= 8)
),
found as (
    select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from windows) where n > 1
),
repeats as (
    select doc_id, sum(least(8, coalesce(nxt - i, 8)))::bigint as n
    from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from found) group by doc_id
),
counts as (
    select d.doc_id, d.lang, d.source, len(w)::bigint as n_words,
        length(regexp_replace(t, '[ \t\n\x0B\f\r]', '', 'g'))::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        length(regexp_replace(t, '[^A-Z]', '', 'g'))::bigint as n_upper,
        length(regexp_replace(t, '[^!]', '', 'g'))::bigint as n_marks,
        len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
        coalesce(r.n, 0)::bigint as n_repeat_words,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::bigint as n_echoes
    from words d left join repeats r on d.doc_id = r.doc_id
),
judged as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counts
),
"""

_FENCES_SQL = """
measures as (
    select doc_id, lang, source, base_failed, mv.m as m, mv.scale * mv.n // greatest(mv.of, 1) as v,
        mv.scale * greatest(mv.n - mv.slack, 0) // greatest(mv.of, 1) as beyond
    from (
        select doc_id, lang, source, base_failed, unnest([
            {'m': 'symbols', 'n': n_symbols, 'of': n_words, 'scale': 1000, 'slack': 2},
            {'m': 'upper', 'n': n_upper, 'of': word_chars, 'scale': 1000, 'slack': 2},
            {'m': 'marks', 'n': n_marks, 'of': n_words, 'scale': 1000, 'slack': 2},
            {'m': 'dup_lines', 'n': n_dup_lines, 'of': n_lines, 'scale': 1000, 'slack': 2},
            {'m': 'repeats', 'n': n_repeat_words, 'of': n_words, 'scale': 1000, 'slack': 2},
            {'m': 'echoes', 'n': n_echoes, 'of': n_words, 'scale': 1000, 'slack': 2},
            {'m': 'word_length', 'n': word_chars, 'of': n_words, 'scale': 100, 'slack': 0}]) as mv
        from judged)
),
sketch as (
    select lang, source, m, v - v % (10 ** greatest(length(v::varchar) - 3, 0))::bigint as b, count(*) as n
    from measures where not base_failed group by all
),
levels as (
    select 3 as level, lang, source, m, b, n from sketch
    union all select 2, lang, null, m, b, sum(n) from sketch group by lang, m, b
    union all select 1, null, null, m, b, sum(n) from sketch group by m, b
),
ranked as (
    select *, sum(n) over (partition by level, lang, source, m order by b) as upto,
        sum(n) over (partition by level, lang, source, m) as total
    from levels
),
quartiles as (
    select level, lang, source, m, max(total) as n_docs, min(b) filter (4 * upto >= total) as q1,
        min(b) filter (2 * upto >= total) as q2, min(b) filter (4 * upto >= 3 * total) as q3
    from ranked group by all
),
shares as (
    select lang, m, b, floor(n * 1000000 / sum(n) over (partition by lang, source, m))::bigint as n from sketch
),
tail_levels as (
    select 2 as level, lang, m, b, sum(n) as n from shares group by lang, m, b
    union all select 1, null, m, b, sum(n) from shares group by m, b
),
tail_ranked as (
    select *, sum(n) over (partition by level, lang, m order by b) as upto, sum(n) over (partition by level, lang, m) as total
    from tail_levels
),
tails as (
    select level, lang, m, min(b) filter (200 * upto >= total) as t_low, min(b) filter (200 * upto >= 199 * total) as t_high
    from tail_ranked group by all
),
mosts(m, most) as (
    values ('symbols', 150), ('upper', 200), ('marks', 200), ('dup_lines', 500), ('repeats', 280), ('echoes', 200),
        ('word_length', 250)
),
groups as (
    select o.lang, o.source, o.m, most,
        case when o.n_docs >= 200 then o.q1 when l.n_docs >= 200 then l.q1 else a.q1 end as q1,
        case when o.n_docs >= 200 then o.q2 when l.n_docs >= 200 then l.q2 else a.q2 end as q2,
        case when o.n_docs >= 200 then o.q3 when l.n_docs >= 200 then l.q3 else a.q3 end as q3,
        case when l.n_docs >= 200 then lt.t_low else t.t_low end as t_low,
        case when l.n_docs >= 200 then lt.t_high else t.t_high end as t_high
    from (select * from quartiles where level = 3) o
    join (select * from quartiles where level = 2) l on l.m = o.m and l.lang is not distinct from o.lang
    join (select * from quartiles where level = 1) a on a.m = o.m
    join (select * from tails where level = 2) lt on lt.m = o.m and lt.lang is not distinct from o.lang
    join (select * from tails where level = 1) t on t.m = o.m
    join mosts on mosts.m = o.m
),
chosen as (
    select lang, source, m, q2 + greatest(10 * (q2 - q1), least(t_high - q2, most)) as high,
        case when m = 'word_length' then q2 - greatest(10 * (q3 - q2), least(q2 - t_low, most)) end as low
    from groups
),
outside as (
    select v.doc_id, bool_or(beyond > high or coalesce(v.v < low, false)) as bad
    from measures v join chosen c on c.m = v.m and c.lang is not distinct from v.lang
        and c.source is not distinct from v.source
    group by v.doc_id
)
"""

ORACLE = {
    "op9_quality_rules": "with "
    + _COUNTS_SQL
    + _FENCES_SQL
    + """
select j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and not coalesce(o.bad, true) as kept
from judged j left join outside o on o.doc_id = j.doc_id
""",
}
