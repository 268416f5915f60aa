"""Personal finance: enriched transactions and the expense, income and savings reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import kpi
from ledgerline.functions.categories import CATEGORY_RULES, categorize
from ledgerline.functions.ordering import ascending, descending

DEBIT, CREDIT = "DEBIT", "CREDIT"


def categorize_transactions(
    raw: DataFrame, rules: Sequence[tuple[str, str]] = CATEGORY_RULES
) -> DataFrame:
    return raw.withColumn("category", categorize("description", "category", rules))


def enrich_transactions(
    raw: DataFrame, rules: Sequence[tuple[str, str]] = CATEGORY_RULES
) -> DataFrame:
    """Curated transactions: keyword category, short month name and year added."""
    return categorize_transactions(raw, rules).withColumns(
        {"month_name": F.monthname("txn_date"), "year": F.year("txn_date")}
    )


def debits(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("type") == DEBIT)


def _spent() -> Column:
    return F.sum(F.abs("amount"))


def credit_amount() -> Column:
    return F.when(F.col("type") == CREDIT, F.col("amount")).otherwise(0)


def debit_amount() -> Column:
    return F.when(F.col("type") == DEBIT, F.abs("amount")).otherwise(0)


def monthly_expense(transactions: DataFrame) -> DataFrame:
    return (
        debits(transactions)
        .groupBy(F.trunc("txn_date", "MM").alias("month"))
        .agg(_spent().alias("expense"))
        .orderBy(ascending("month"))
    )


def category_expense(transactions: DataFrame) -> DataFrame:
    return debits(transactions).groupBy("category").agg(_spent().alias("expense"))


def income_expense(transactions: DataFrame, by_year: bool = False) -> DataFrame:
    """Income and expense per month name, months of all years together and in alphabetical order.

    ``by_year`` keeps the years apart instead.
    """
    month = F.monthname("txn_date").alias("month")
    keys = [F.year("txn_date").alias("year"), month] if by_year else [month]
    grouped = transactions.groupBy(*keys).agg(
        F.sum(credit_amount()).alias("income"), F.sum(debit_amount()).alias("expense")
    )
    return grouped.orderBy(*[ascending(c) for c in (("year", "month") if by_year else ("month",))])


def _merchants(transactions: DataFrame) -> DataFrame:
    return (
        debits(transactions)
        .groupBy("description")
        .agg(F.count("*").alias("transaction_count"), _spent().alias("total_spend"))
    )


def merchant_spend(transactions: DataFrame) -> DataFrame:
    return _merchants(transactions).orderBy(descending("total_spend"), ascending("description"))


def top_merchants(transactions: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` merchants with the highest spend; equal spends are taken by description.

    Sort and limit become one top-k per partition, so only ``k`` rows per task are merged.
    """
    return merchant_spend(transactions).limit(k)


def savings(transactions: DataFrame) -> DataFrame:
    income, expense = F.sum(credit_amount()), F.sum(debit_amount())
    return transactions.agg(
        income.alias("income"), expense.alias("expense"), (income - expense).alias("savings")
    )


def savings_rate(transactions: DataFrame) -> DataFrame:
    return savings(transactions).withColumn("savings_rate", kpi.savings_rate("savings", "income"))


def financial_health(transactions: DataFrame) -> DataFrame:
    rated = savings_rate(transactions)
    return rated.select("savings_rate", kpi.rating("savings_rate").alias("rating"))


def kpi_row(transactions: DataFrame) -> DataFrame:
    """The four headline figures as display text, without the currency sign."""
    row = savings_rate(transactions)
    return row.select(
        *[kpi.with_thousands(F.bround(c, 0)).alias(c) for c in ("income", "expense", "savings")],
        F.concat(F.col("savings_rate").cast("string"), F.lit("%")).alias("savings_rate"),
    )


#: The reports as views over curated transactions, by the name a SQL reader uses.
VIEWS = {
    "vw_monthly_expense": monthly_expense,
    "vw_category_expense": category_expense,
    "vw_income_expense": income_expense,
    "vw_top_merchants": merchant_spend,
    "vw_savings": savings,
}


def create_views(transactions: DataFrame) -> None:
    """Makes the reports readable by name; each is inlined into the query that reads it."""
    for name, report in VIEWS.items():
        report(transactions).createOrReplaceTempView(name)
