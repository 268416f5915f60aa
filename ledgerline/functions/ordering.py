"""Sort orders that treat NULL as the largest value: first when descending, last when ascending."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def descending(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def ascending(name: str) -> Column:
    return F.col(name).asc_nulls_last()
