"""Headline figures: rates, rating bands and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds (per cent) and names of the rating bands, best first.
RATING_BANDS = ((40, "Excellent"), (20, "Good"), (10, "Average"))
LOWEST_RATING = "High Spending"


def savings_rate(savings: str, income: str) -> Column:
    """Savings in per cent of income, half-even to 2 digits; 0 unless the income is positive."""
    earned = F.col(income).cast("double")
    # The guard sits inside the divisor as well: ANSI mode would raise on a zero income.
    share = F.col(savings).cast("double") / F.when(earned > 0, earned)
    return F.coalesce(F.bround(share * 100, 2), F.lit(0.0))


def rating(rate: str) -> Column:
    bands = F.when(F.col(rate) >= RATING_BANDS[0][0], RATING_BANDS[0][1])
    for bound, name in RATING_BANDS[1:]:
        bands = bands.when(F.col(rate) >= bound, name)
    return bands.otherwise(LOWEST_RATING)


def average(total: Column, count: Column) -> Column:
    """``total / count`` as a double; NULL when there is nothing to average."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def rounded(value: Column | str, digits: int = 2) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("double"), digits)


def with_thousands(value: Column | str, digits: int = 0) -> Column:
    """Text such as ``1,234,567``."""
    return F.format_number(value, digits)
