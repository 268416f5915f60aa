"""URL filter: allow and block rules, and gradient-boosted trees for all URLs that no rule decides.

A rule names a host and the start of a path; it fits the host and its subdomains, and the longest rule
that fits decides. The URLs that rules decide are the labelled ones: the trees learn from them, by
lexical features alone, and give the verdict of the others. The features are lengths, depth, digit
ratio, character entropy, counts of parameters and marks, and the smoothed block rates of the host's
last label and of the path's first segment among the labelled URLs.

The trees are fitted on at most ``max_labels`` labelled URLs, the first by hash; every URL is judged.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule and is judged
by its features; without labelled URLs of both kinds the verdict is the only kind there is, or allow;
repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, table, whole


@dataclass(frozen=True)
class Rule:
    """A host with the start of a path, such as ``example.org/en/``."""

    place: str
    allow: bool

    @property
    def host(self) -> str:
        return self.place.partition("/")[0]

    @property
    def path(self) -> str:
        return self.place[len(self.host) :]


RULES = (
    Rule("org/", True),
    Rule("example.org/es/", False),
    Rule("example.org/en/1", False),
    Rule("com/fr/", True),
    Rule("com/de/", False),
)
MAX_LABELS = 20_000
#: Labelled URLs that the overall block rate counts as, in the rate of a suffix or segment.
SMOOTHING = 20

FEATURES = (
    "url_length",
    "host_length",
    "path_length",
    "depth",
    "labels",
    "digit_ratio",
    "entropy",
    "parameters",
    "hyphens",
    "secure",
    "fragment",
    "file_ending",
    "suffix_rate",
    "segment_rate",
)


def with_parts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``host`` and ``path``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return pages.select(
        "page_id",
        whole("url").alias("url"),
        F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"),
    )


def rule_of(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The place of the longest rule that fits, and whether it allows; null if none fits."""
    places, allows = [], []
    for rule in sorted(rules, key=lambda r: -len(r.place)):
        host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = host & F.col("path").startswith(rule.path)
        places.append(F.when(fits, F.lit(rule.place)))
        allows.append(F.when(fits, F.lit(rule.allow)))
    return F.coalesce(*places), F.coalesce(*allows)


def _count(column: str, character: str) -> Column:
    return F.char_length(column) - F.char_length(F.replace(F.col(column), F.lit(character), F.lit("")))


def _entropy(column: str) -> Column:
    length = F.char_length(column).cast("double")
    share = lambda c: (length - F.char_length(F.replace(F.col(column), c, F.lit("")))) / length
    parts = F.transform(F.array_distinct(F.split(column, "")), lambda c: -share(c) * F.log2(share(c)))
    return F.when(length > 0, F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)).otherwise(0.0)


def lexical(parts: DataFrame) -> DataFrame:
    """Adds the features that need the URL alone, and the keys of the other two."""
    length = F.char_length("url").cast("double")
    digits = length - F.char_length(F.translate(F.col("url"), string.digits, ""))
    own = {
        "url_length": length,
        "host_length": F.char_length("host"),
        "path_length": F.char_length("path"),
        "depth": _count("path", "/"),
        "labels": _count("host", ".") + 1,
        "digit_ratio": F.when(length > 0, digits / length).otherwise(0.0),
        "entropy": _entropy("url"),
        "parameters": _count("url", "=") + _count("url", "&"),
        "hyphens": _count("url", "-") + _count("url", "_"),
        "secure": F.col("url").startswith("https://").cast("double"),
        "fragment": F.col("url").contains("#").cast("double"),
        "file_ending": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
    }
    return parts.select(
        "*",
        *[c.cast("double").alias(n) for n, c in own.items()],
        F.substring_index("host", ".", -1).alias("suffix"),
        F.regexp_extract("path", r"^/([^/]*)", 1).alias("segment"),
    )


def _rates(labelled: DataFrame, key: str, rate: float) -> DataFrame:
    blocked = F.sum(F.col("label")) + F.lit(rate * SMOOTHING)
    return labelled.groupBy(key).agg((blocked / (F.count("*") + F.lit(float(SMOOTHING)))).alias(f"{key}_rate"))


def _with_rates(df: DataFrame, tables: dict[str, DataFrame], rate: float) -> DataFrame:
    for key, rates in tables.items():
        df = df.join(rates, key, "left").fillna({f"{key}_rate": rate})
    return df


def verdicts(pages: DataFrame, rules: tuple[Rule, ...] = RULES, max_labels: int = MAX_LABELS) -> DataFrame:
    """One row per page with its host, path, rule and verdict."""
    place, allow = rule_of(rules)
    judged = with_parts(pages).withColumns({"rule": place, "allow": allow})
    labelled = stored(
        judged.where(F.col("allow").isNotNull())
        .select("url", "host", "path", (~F.col("allow")).cast("double").alias("label"))
        .orderBy(F.xxhash64("url"), "url")
        .limit(max_labels),
        "url-labels",
    )
    n, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or blocked in (0, n):
        by_model = judged.withColumn("block", F.lit(bool(n and blocked == n)))
    else:
        rate = blocked / n
        known = lexical(labelled)
        rates = {key: stored(_rates(known, key, rate), f"url-{key}") for key in ("suffix", "segment")}
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        training = assembler.transform(_with_rates(known, rates, rate)).select("features", "label")
        training = stored(training.repartition(8), "url-features").coalesce(8)
        model = GBTClassifier(maxIter=20, maxDepth=4, maxBins=64, seed=7, cacheNodeIds=False).fit(training)
        scored = model.transform(assembler.transform(_with_rates(lexical(judged), rates, rate)))
        by_model = scored.withColumn("block", vector_to_array("probability")[1] > 0.5)
    verdict = F.when(F.coalesce("allow", ~F.col("block")), "allow").otherwise("block")
    return by_model.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "pages"))
