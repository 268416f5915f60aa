"""Retail sales: star schema, sales view, rollups and the stored product sums."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerline.functions.kpi import with_thousands
from ledgerline.functions.ordering import descending
from ledgerline.operators.changes import DELETE, META, OP
from ledgerline.operators.joins import COUNT, SUM, aggregate_by_lookup

FACT_COLUMNS = {
    "order_id": "order_id",
    "customer_id": "customer_id",
    "product_id": "product_id",
    "store_id": "store_id",
    "qty": "qty",
    "price": "sales_amount",
    "order_date": "order_date",
}
VIEW_COLUMNS = ("customer_name", "product_name", "store_name", "sales_amount", "order_date")


def build_dim(raw: DataFrame) -> DataFrame:
    """A dimension is the raw table as it is."""
    return raw.select("*")


def build_fact_sales(raw_orders: DataFrame) -> DataFrame:
    """Order rows as facts. The sales amount is the price alone; the quantity is not multiplied in."""
    return raw_orders.select(
        *[
            F.col(source).alias(target)
            for source, target in FACT_COLUMNS.items()
            if source in raw_orders.columns
        ]
    )


def load_fact_sales(changes: DataFrame, as_written: bool = False) -> DataFrame:
    """The fact rows to append for a range of raw-order changes.

    New images are loaded and deletes are left out; ``as_written`` loads deletes as rows as well,
    which is what a load that ignores the change action does.
    """
    rows = changes if as_written else changes.where(F.col(OP) != DELETE)
    return build_fact_sales(rows.drop(*META))


def _star(
    facts: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    """Facts with their dimension names; a fact lacking any dimension drops out.

    No broadcast is forced: Spark broadcasts each dimension that its size estimate or, at run time,
    its measured size allows, and otherwise uses a sort-merge join whose skewed partitions are split.
    Customers, usually the largest dimension, come first and stores last, so that the rows are
    narrowest where they may have to be shuffled.
    """
    return (
        facts.join(customers.select("customer_id", "customer_name"), "customer_id")
        .join(products.select("product_id", "product_name"), "product_id")
        .join(stores.select("store_id", "store_name"), "store_id")
    )


def sales_view(
    facts: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    return _star(facts, customers, products, stores).select(*VIEW_COLUMNS)


def recent_sales(
    facts: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    """The sales view, latest first.

    Order id and amount extend the sort key, so the sort's ranges can split a date that owns a large
    share of all sales.
    """
    return (
        _star(facts, customers, products, stores)
        .orderBy(descending("order_date"), descending("order_id"), descending("sales_amount"))
        .select(*VIEW_COLUMNS)
    )


def total_sales(facts: DataFrame) -> DataFrame:
    return facts.agg(F.coalesce(F.sum("sales_amount"), F.lit(0)).alias("total_sales"))


def total_orders(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count("*").alias("total_orders"))


def kpi_row(facts: DataFrame) -> DataFrame:
    """Total sales as display text with all its digits, and the number of orders."""
    amount = facts.schema["sales_amount"].dataType
    digits = amount.scale if isinstance(amount, DecimalType) else 0
    row = facts.agg(
        F.coalesce(F.sum("sales_amount"), F.lit(0)).alias("total_sales"),
        F.count("*").alias("total_orders"),
    )
    return row.withColumn("total_sales", with_thousands("total_sales", digits))


def product_sales(facts: DataFrame, products: DataFrame) -> DataFrame:
    sums = aggregate_by_lookup(
        facts, products, "product_id", ["product_name"], {"total_sales": (SUM, "sales_amount")}
    )
    return sums.orderBy(descending("total_sales"), "product_name")


def store_sales(facts: DataFrame, stores: DataFrame) -> DataFrame:
    sums = aggregate_by_lookup(
        facts, stores, "store_id", ["store_name"], {"total_sales": (SUM, "sales_amount")}
    )
    return sums.orderBy(descending("total_sales"), "store_name")


def customer_orders(
    facts: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    """Sales view rows per customer name, most first.

    Product and store only decide whether a fact is in the view; the rest is counted per customer id
    before the names are looked up.
    """
    in_view = facts.join(stores.select("store_id"), "store_id").join(
        products.select("product_id"), "product_id"
    )
    counts = aggregate_by_lookup(
        in_view, customers, "customer_id", ["customer_name"], {"total_orders": (COUNT, "*")}
    )
    return counts.orderBy(descending("total_orders"), "customer_name")


def sales_summary(facts: DataFrame) -> DataFrame:
    """Sales per product id, the query behind the lagging summary table."""
    return facts.groupBy("product_id").agg(F.sum("sales_amount").alias("total_sales"))


def sales_on(facts: DataFrame, day: dt.date | str) -> DataFrame:
    """Facts of one day; the literal is cast to the column's date type and pushed to the scan."""
    return facts.where(F.col("order_date") == F.lit(str(day)).cast("date"))


def create_view(
    facts: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame
) -> None:
    """Makes the sales view readable by name in SQL."""
    sales_view(facts, customers, products, stores).createOrReplaceTempView("sales_view")
