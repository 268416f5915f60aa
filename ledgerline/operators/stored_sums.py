"""A grouped SUM kept up to date from row changes instead of being recomputed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.changes import ACTION, OP, _sign

TOTAL, ROWS, VALUES = "total", "row_count", "value_count"


def partial_sums(rows: DataFrame, key: str, measure: str) -> DataFrame:
    """Sum, row count and non-null count per key; deleted rows of a change set count negatively.

    An update has to come as a DELETE of the old row and an INSERT of the new one, as net changes and
    ``split_updates`` give it; one without its old image raises. The counts make the sums maintainable: a key whose rows are all deleted has to vanish, and one
    left with only NULL measures has a NULL sum.
    """
    sign = F.lit(1)
    marker = next((c for c in (ACTION, OP) if c in rows.columns), None)
    if marker is not None:
        sign = _sign(rows, marker)
    value = F.col(measure)
    return rows.groupBy(key).agg(
        F.sum(F.when(sign > 0, value).otherwise(-value)).alias(TOTAL),
        F.sum(sign.cast("long")).alias(ROWS),
        F.sum(F.when(value.isNotNull(), sign).otherwise(0).cast("long")).alias(VALUES),
    )


def merge_sums(stored: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Stored partial sums with the partial sums of later changes added, key by key."""
    return (
        stored.unionByName(delta)
        .groupBy(key)
        .agg(*[F.sum(c).alias(c) for c in (TOTAL, ROWS, VALUES)])
        .where(F.col(ROWS) != 0)
    )


def read_sums(stored: DataFrame, key: str) -> DataFrame:
    """The view over stored partial sums: ``key`` and its ``SUM``."""
    return stored.select(key, F.when(F.col(VALUES) != 0, F.col(TOTAL)).alias(TOTAL))
