"""Joins shaped so that the large side is reduced before it is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "count"
SUM = "sum"


def _partial(measure: tuple[str, str]) -> Column:
    kind, column = measure
    if kind == COUNT:
        return F.count("*") if column == "*" else F.count(column)
    if kind == SUM:
        return F.sum(column)
    raise ValueError(f"unknown measure {kind!r}")


def aggregate_by_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    on: str,
    by: Sequence[str],
    measures: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """``facts JOIN dimension USING (on) GROUP BY by`` with SUM and COUNT measures.

    Sums and counts may be taken per join key first: each map task then ships at most one row per key
    it holds, so neither the size of the fact table nor a key owning a third of it reaches the
    shuffle. The second aggregation keeps the result equal to the plain join also when the dimension
    repeats a key (each copy counts again) or lacks one (its facts drop out). ``by`` names columns
    of the dimension.
    """
    per_key = (
        facts.where(F.col(on).isNotNull())
        .groupBy(on)
        .agg(*[_partial(m).alias(name) for name, m in measures.items()])
    )
    wanted = [c for c in dimension.columns if c == on or c in by]
    return (
        per_key.join(dimension.select(*wanted), on)
        .groupBy(*by)
        .agg(*[F.sum(name).alias(name) for name in measures])
    )
