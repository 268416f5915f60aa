"""Customer orders: spend per customer, with the amount masked by role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.masking import AMOUNT_MASK, mask
from ledgerline.functions.ordering import descending
from ledgerline.operators.joins import COUNT, SUM, aggregate_by_lookup


def masked_orders(orders: DataFrame, role: str) -> DataFrame:
    return mask(orders, {"amount": AMOUNT_MASK}, role)


def customer_summary(
    customers: DataFrame, orders: DataFrame, role: str | None = None
) -> DataFrame:
    """Orders and spend per customer who has any.

    With a ``role``, amounts are masked in the orders first, so a masked reader sums zeros.
    """
    seen = orders if role is None else masked_orders(orders, role)
    return aggregate_by_lookup(
        seen,
        customers,
        "customer_id",
        ["customer_id", "name", "city"],
        {"total_orders": (COUNT, "order_id"), "total_spent": (SUM, "amount")},
    )


def mv_customer(summary: DataFrame) -> DataFrame:
    return summary.select("name", "total_spent")


def spend_by_name(summary: DataFrame) -> DataFrame:
    """Spend per customer name, largest first; customers sharing a name are added up."""
    return (
        summary.groupBy("name")
        .agg(F.sum("total_spent").alias("total_spent"))
        .orderBy(descending("total_spent"), "name")
    )
