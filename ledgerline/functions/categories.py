"""Keyword categories: the first pattern found in the lower-cased text names the category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The keyword patterns and categories of the enrichment, in matching order.
CATEGORY_RULES = (
    ("%swiggy%", "Food"),
    ("%amazon%", "Shopping"),
    ("%uber%", "Travel"),
    ("%netflix%", "Entertainment"),
    ("%sip%", "Investment"),
)


def categorize(
    text: Column | str,
    default: Column | str,
    rules: Sequence[tuple[str, str]] = CATEGORY_RULES,
) -> Column:
    """Category of ``text`` by the first matching ``LIKE`` pattern, else ``default``.

    A substring match is enough, so ``%sip%`` also finds "gossip"; NULL text matches nothing.
    """
    lowered = F.lower(text)
    fallback = F.col(default) if isinstance(default, str) else default
    category = None
    for pattern, name in rules:
        matches = lowered.like(pattern)
        category = F.when(matches, name) if category is None else category.when(matches, name)
    return fallback if category is None else category.otherwise(fallback)
