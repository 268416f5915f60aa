"""Mixing sources to target weights by iterative proportional fitting.

The tokens of every cell, a combination of source, language and topic, are raked until their sums match
the target shares of all three margins. A document is then kept with the probability that its cell's
raked tokens have against its tokens, at the largest scale at which no probability exceeds one. So the
expected tokens of the sample have the target shares in every margin.

That scale is set by the cell that is shortest of its target, however small. With ``least_kept`` the sample has
that share of the tokens instead: cells that are short of their target for it are kept whole, and the others are raked
anew to what is left of the targets. Then a value all of whose documents are kept falls short of its target, and the
values of its dimension that are not keep their targets' proportions. So one small source changes next to nothing.
The query and the pipeline both use ``PRODUCTION``, which is so.

Topics come from ordered patterns over the text. Targets are shares by value, or an exponent: shares in
proportion to a power of the shares found, which lifts small values and lowers large ones. A value
without a target gets nothing and is never kept; a target without documents is left out and the others
are scaled to fill it.

The raking runs on the table of cells, in DataFrame steps of which each sweep is cut off by a
checkpoint; only single numbers come to the driver. If the sweeps end with a margin farther from its goal than
``warn_at`` of all tokens, a warning tells so. All is DataFrame functions.

Defined results: null languages and sources are values of their own, a null text has no tokens; such
documents are judged by their cell like any other, and a cell without tokens is kept whole; rows with equal ids and
texts are kept or left together; very long texts are counted whole; other columns, whatever their names, play no
part and go through the sample as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.llm.common import free_name, stored, table, whole, words

DIMENSIONS = ("source", "lang", "topic")
#: Topic and pattern; the first pattern found decides.
TOPICS = (
    ("licence", "[Ll]icen[sc]e|[Cc]opyright"),
    ("contact", "@|https?://"),
    ("listing", "[|{}]"),
)
OTHER_TOPIC = "prose"


@dataclass(frozen=True)
class Mix:
    """Targets of each dimension: an exponent, or shares by value (``None`` for null)."""

    targets: Mapping[str, float | Mapping[str | None, float]] = field(
        default_factory=lambda: {"source": 0.8, "lang": 0.9, "topic": 0.9}
    )
    sweeps: int = 20
    tolerance: float = 1e-12
    seed: int = 17
    #: Share of the tokens with a target that the sample has; 0 keeps the targets, whatever is left then.
    least_kept: float = 0.0
    #: Miss of a margin, as a share of all tokens, from which on a warning is given.
    warn_at: float = 0.001


#: Sweeps over all margins between two written tables.
SWEEPS_AT_ONCE = 5
#: The rule of the query and of the pipeline.
PRODUCTION = Mix(least_kept=0.6)


def topic(text: Column) -> Column:
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, pattern in TOPICS:
        chosen = chosen.when(text.rlike(pattern), F.lit(name))
    return chosen.otherwise(OTHER_TOPIC)


def _keys(docs: DataFrame) -> dict[str, Column]:
    return {"source": docs["source"], "lang": docs["lang"], "topic": topic(whole("text"))}


def cells(docs: DataFrame) -> DataFrame:
    """Documents and tokens of each cell; the tokens of a document are its words."""
    return (
        docs.select(*[c.alias(n) for n, c in _keys(docs).items()], F.size(words(whole("text"))).cast("long").alias("t"))
        .groupBy(*DIMENSIONS)
        .agg(F.count("*").alias("docs"), F.sum("t").alias("tokens"))
    )


def _shares(found: DataFrame, dimension: str, target: float | Mapping[str | None, float]) -> DataFrame:
    """The target share of every value of a dimension that has tokens; they sum to one."""
    margin = found.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("tokens")).where("tokens > 0")
    if isinstance(target, Mapping):
        schema = T.StructType([T.StructField("v", T.StringType()), T.StructField("raw", T.DoubleType())])
        given = found.sparkSession.createDataFrame([(k, float(v)) for k, v in target.items()], schema)
        margin = margin.join(given, F.col(dimension).eqNullSafe(F.col("v")), "left").fillna({"raw": 0.0})
    else:
        margin = margin.withColumn("raw", F.pow(F.col("tokens"), F.lit(float(target))))
    total = margin.agg(F.sum("raw").alias("all_raw"))
    share = F.when(F.col("all_raw") > 0, F.col("raw") / F.col("all_raw")).otherwise(0.0)
    return margin.join(total, F.lit(True)).select(F.col(dimension).alias("value"), share.alias(f"{dimension}_share"))


def raked(found: DataFrame, mix: Mix) -> DataFrame:
    """``found`` with ``weight``: the raked share of the cell's tokens."""
    now = found.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        shares = _shares(found, d, mix.targets[d])
        now = now.join(shares, F.col(d).eqNullSafe(F.col("value"))).drop("value")
    now = stored(now, "mixing-cells")
    missed = 0.0
    for sweep in range(mix.sweeps):
        for d in DIMENSIONS:
            margin = F.sum("weight").over(Window.partitionBy(d))
            fitted = F.when(margin > 0, F.col("weight") * F.col(f"{d}_share") / margin).otherwise(0.0)
            now = now.withColumn("weight", fitted)
        if (sweep + 1) % SWEEPS_AT_ONCE and sweep + 1 < mix.sweeps:
            continue
        now = stored(now, "mixing-cells")
        # After a sweep the last margin fits; the first is off by as much as the sweeps still move.
        first = DIMENSIONS[0]
        miss = now.groupBy(first).agg(F.abs(F.sum("weight") - F.max(f"{first}_share")).alias("m"))
        missed = miss.agg(F.max("m")).first()[0] or 0.0
        if missed <= mix.tolerance:
            return now
    return _told(now, missed, mix)


def _told(now: DataFrame, missed: float, mix: Mix) -> DataFrame:
    if missed > mix.warn_at:
        warnings.warn(f"mixing: after {mix.sweeps} sweeps a margin is still off by {missed:.2%} of the tokens", stacklevel=2)
    return now


def _level(margin: DataFrame, total: float) -> float:
    """The factor at which the sum of the values' shares times it, each cut at what it is able to give, is ``total``.

    Each step takes the values that are cut at the last factor as given and solves for the others; more and more are
    cut, so the steps end. Two sums come to the driver, whatever the number of values.
    """
    factor = total
    while True:
        cut = F.col("able") <= F.col("share") * F.lit(factor)
        given, open_, most = margin.agg(
            F.sum(F.when(cut, F.col("able"))), F.sum(F.when(~cut, F.col("share"))),
            F.max(F.when(F.col("share") > 0, F.col("able") / F.col("share"))),
        ).first()
        if not open_:
            return most or 0.0
        later = (total - (given or 0.0)) / open_
        if later <= factor * (1 + 1e-15):
            return later
        factor = later


def _step(d: str) -> Column:
    """The weights after one margin of ``d`` is brought to its goal.

    A margin that is too large shrinks as a whole. One that is too small takes what it lacks from its cells that
    have more to give; those that give all they have stay so. Where that is not enough, the next sweep goes on.
    """
    own = Window.partitionBy(d)
    weight, most, goal = F.col("weight"), F.col("most"), F.col(f"{d}_goal")
    total = F.sum("weight").over(own)
    full = F.sum(F.when(weight >= most, most).otherwise(0.0)).over(own)
    grown = F.when(weight >= most, weight).otherwise(F.least(most, weight * (goal - full) / (total - full)))
    return F.when(total <= 0, 0.0).when(goal >= total, grown).otherwise(weight * goal / total)


def bounded(fitted: DataFrame, mix: Mix, total: float) -> DataFrame:
    """``fitted`` raked anew to ``total`` tokens, of no cell more than it has; ``weight`` is in tokens.

    A margin gets its share of the total, or all it has and the other values the rest.
    """
    now = fitted.withColumn("weight", F.col("weight") * total)
    for d in DIMENSIONS:
        able = F.sum(F.when(F.col("weight") > 0, F.col("tokens")).otherwise(0)).cast("double")
        margin = stored(fitted.groupBy(d).agg(able.alias("able"), F.max(f"{d}_share").alias("share")), "mixing-margin")
        goal = F.least(F.col("able"), F.col("share") * F.lit(_level(margin, total)))
        goals = stored(margin.select(F.col(d).alias("value"), goal.alias(f"{d}_goal")), "mixing-goals")
        now = now.join(goals, F.col(d).eqNullSafe(F.col("value"))).drop("value")
    most = F.col("tokens").cast("double")
    now = stored(now.withColumn("most", most).withColumn("weight", F.least("weight", "most")), "mixing-cells")
    first, missed = DIMENSIONS[0], 0.0
    for sweep in range(mix.sweeps):
        for d in DIMENSIONS:
            now = now.withColumn("weight", _step(d))
        if (sweep + 1) % SWEEPS_AT_ONCE and sweep + 1 < mix.sweeps:
            continue
        now = stored(now, "mixing-cells")
        miss = now.groupBy(first).agg(F.abs(F.sum("weight") - F.max(f"{first}_goal")).alias("m"))
        missed = (miss.agg(F.max("m")).first()[0] or 0.0) / total
        if missed <= 1e-12:
            break
    return _told(now, missed, mix)


def probabilities(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Each cell with the probability at which its documents are kept."""
    found = stored(cells(docs), "mixing-found")
    fitted = raked(found, mix)
    if mix.least_kept > 0:
        usable = fitted.where("weight > 0")
        able = usable.agg(F.sum("tokens").cast("double")).first()[0]
        if able:
            fitted = bounded(fitted, mix, mix.least_kept * able)
            share = F.least(F.lit(1.0), F.col("weight") / F.col("tokens"))
            return _with_idle(fitted.select(*DIMENSIONS, share.alias("probability")), found)
    fitted = fitted.withColumn("ratio", F.col("weight") / F.col("tokens"))
    top = fitted.agg(F.max("ratio").alias("top"))
    probability = F.when(F.col("top") > 0, F.col("ratio") / F.col("top")).otherwise(0.0)
    return _with_idle(fitted.join(top, F.lit(True)).select(*DIMENSIONS, probability.alias("probability")), found)


def _with_idle(known: DataFrame, found: DataFrame) -> DataFrame:
    """``known`` and the cells without tokens, which are kept whole."""
    idle = found.where("tokens = 0").select(*DIMENSIONS, F.lit(1.0).alias("probability"))
    return stored(known.union(idle), "mixing-probabilities")


def _draw(seed: int) -> Column:
    """A number in [0, 1) that depends on the document alone."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(whole("text")))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def _with_probability(docs: DataFrame, mix: Mix, topic_name: str, name: str) -> DataFrame:
    own = {"source": "source", "lang": "lang", "topic": topic_name}
    cell = {d: free_name(docs, f"cell_{d}") for d in DIMENSIONS}
    chances = probabilities(docs, mix).select(
        *[F.col(d).alias(cell[d]) for d in DIMENSIONS], F.coalesce("probability", F.lit(0.0)).alias(name)
    )
    on = F.lit(True)
    for d in DIMENSIONS:
        on = on & F.col(own[d]).eqNullSafe(F.col(cell[d]))
    # Every document has a cell: the table was counted from them.
    return docs.withColumn(topic_name, topic(whole("text"))).join(chances, on).drop(*cell.values())


def mix_report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document with its cell, its probability and whether it is in the sample."""
    chosen = _with_probability(docs.select("doc_id", "text", "lang", "source"), mix, "topic", "chance")
    return chosen.select(
        "doc_id",
        *DIMENSIONS,
        F.round("chance", 6).alias("probability"),
        (_draw(mix.seed) < F.col("chance")).alias("sampled"),
    )


def mixed_sample(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents of the sample, with the columns they came with."""
    topic_name, chance = free_name(docs, "mix_topic"), free_name(docs, "mix_chance")
    chosen = _with_probability(docs, mix, topic_name, chance)
    return chosen.where(_draw(mix.seed) < F.col(chance)).select(*docs.columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"), PRODUCTION)


def _sweep_sql(sweeps: int) -> str:
    steps, last = [], "w0"
    for i in range(sweeps):
        for d in DIMENSIONS:
            name = f"w{i}_{d}"
            steps.append(
                f"{name} as materialized (select source, lang, topic, tokens, source_share, lang_share, topic_share, "
                f"weight * {d}_share / sum(weight) over (partition by {d}) as weight from {last})"
            )
            last = name
    return ",\n".join([*steps, f"fitted as materialized (select *, weight / tokens as ratio from {last})"])


def _bounded_sql(sweeps: int, least_kept: float) -> str:
    able = "(select sum(tokens) from fitted where weight > 0)"
    parts = [f"size as materialized (select {least_kept} * {able} as total)"]
    goals = []
    for d in DIMENSIONS:
        upto = "over (order by full_ nulls last range between unbounded preceding and current row)"
        parts.append(
            f"{d}_able as (select {d} as value, sum(case when weight > 0 then tokens else 0 end)::double as able, "
            f"max({d}_share) as share, (select total from size) as total from fitted group by {d})"
        )
        parts.append(
            f"{d}_full as (select *, case when share > 0 then able / share end as full_ from {d}_able),\n"
            f"{d}_cut as (select *, full_ is not null and sum(case when full_ is not null then able end) {upto} "
            f"+ full_ * greatest(sum(share) over () - sum(share) {upto}, 0) <= total as cut_ from {d}_full),\n"
            f"{d}_level as (select coalesce(case when sum(case when cut_ then 0 else share end) > 0 "
            f"then (max(total) - sum(case when cut_ then able else 0 end)) / sum(case when cut_ then 0 else share end) "
            f"else max(full_) end, 0) as level from {d}_cut),\n"
            f"{d}_goals as materialized (select value, least(able, share * (select level from {d}_level)) as goal from {d}_able)"
        )
        goals.append(f"join {d}_goals {d}_g on f.{d} is not distinct from {d}_g.value")
    shown = ", ".join(f"{d}_g.goal as {d}_goal" for d in DIMENSIONS)
    parts.append(
        f"b0 as materialized (select f.source, f.lang, f.topic, f.tokens, least(f.tokens, f.weight * (select total from size)) as weight, {shown} "
        f"from fitted f {' '.join(goals)})"
    )
    last = "b0"
    for i in range(sweeps):
        for d in DIMENSIONS:
            name = f"b{i}_{d}"
            parts.append(
                f"{name}_s as (select *, sum(weight) over (partition by {d}) as all_, "
                f"sum(case when weight >= tokens then tokens else 0 end) over (partition by {d}) as full_ from {last}),\n"
                f"{name} as materialized (select * exclude (all_, full_) replace (case when all_ <= 0 then 0 "
                f"when {d}_goal >= all_ then case when weight >= tokens then weight "
                f"else least(tokens, weight * ({d}_goal - full_) / (all_ - full_)) end "
                f"else weight * {d}_goal / all_ end as weight) from {name}_s)"
            )
            last = name
    parts.append(f"final as (select *, least(1.0, weight / tokens) as p from {last})")
    return ",\n".join(parts)


ORACLE = {
    "op1_mixing": r"""
with tagged as (
    select doc_id, source, lang,
        case when regexp_matches(coalesce(text, ''), '[Ll]icen[sc]e|[Cc]opyright') then 'licence'
            when regexp_matches(coalesce(text, ''), '@|https?://') then 'contact'
            when regexp_matches(coalesce(text, ''), '[|{}]') then 'listing' else 'prose' end as topic,
        len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) as t,
        coalesce(doc_id::varchar, md5(coalesce(text, ''))) as k
    from documents
),
cells as materialized (select source, lang, topic, sum(t)::double as tokens from tagged group by all),
sources as (select source, pow(sum(tokens), 0.8) as raw from cells group by source having sum(tokens) > 0),
langs as (select lang, pow(sum(tokens), 0.9) as raw from cells group by lang having sum(tokens) > 0),
topics as (select topic, pow(sum(tokens), 0.9) as raw from cells group by topic having sum(tokens) > 0),
w0 as materialized (
    select c.source, c.lang, c.topic, tokens, s.raw / (select sum(raw) from sources) as source_share,
        l.raw / (select sum(raw) from langs) as lang_share, t.raw / (select sum(raw) from topics) as topic_share,
        tokens as weight
    from cells c join sources s on c.source is not distinct from s.source
        join langs l on c.lang is not distinct from l.lang join topics t on c.topic = t.topic
    where tokens > 0
),
"""
    + _sweep_sql(PRODUCTION.sweeps)
    + ",\n"
    + _bounded_sql(PRODUCTION.sweeps, PRODUCTION.least_kept)
    + """,
chances as (
    select c.source, c.lang, c.topic,
        case when c.tokens = 0 then 1.0 else f.p end as p
    from cells c left join final f on c.source is not distinct from f.source
        and c.lang is not distinct from f.lang and c.topic = f.topic
)
select d.doc_id, d.source, d.lang, d.topic, round(p, 6) as probability,
    ('0x' || md5('17:' || k)[1:13])::bigint / 4503599627370496.0 < p as sampled
from tagged d join chances c on c.source is not distinct from d.source
    and c.lang is not distinct from d.lang and c.topic = d.topic
""",
}
