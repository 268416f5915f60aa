"""The declared input tables, derived from the generated parquet tables.

Some look up one attribute group in a second table by its primary key: the customer of an order row,
the merchant of a transaction, the place of a customer or store. The lookup is an outer join and never
changes which rows there are, so a report that does not touch those columns leaves it out. That
spares the large tables a shuffle, and lets Spark judge a dimension by its file size: behind a join
its size estimate is the product of both sides, too large to ever be broadcast.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

AMOUNT = DecimalType(18, 2)


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated table. They never change, so the job that reads their schema runs once each."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def _with_nation(df: DataFrame, key: str, nation: DataFrame) -> DataFrame:
    return df.join(nation.select("n_nationkey", "n_name"), df[key] == nation["n_nationkey"], "left")


def _amount(name: str) -> Column:
    return F.col(name).cast(AMOUNT)


# Customer orders.


def crm_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = (table(spark, sf_dir, t) for t in ("customer", "nation"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat("c_mktsegment", F.lit(" "), "n_name").alias("name"),
        F.col("n_name").alias("city"),
    )


def crm_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _amount("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("order_date"),
    )


# Retail.


def _line_columns() -> list[Column]:
    return [
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        _amount("l_extendedprice").alias("price"),
        F.to_date("l_shipdate").alias("order_date"),
    ]


def retail_lines(lineitem: DataFrame) -> DataFrame:
    """Raw order rows without their customer."""
    return lineitem.select(*_line_columns())


def with_customer(lines: DataFrame, orders: DataFrame) -> DataFrame:
    buyers = orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    return lines.join(buyers, "order_id", "left")


RAW_ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "product_id",
    "store_id",
    "qty",
    "price",
    "order_date",
)


def retail_orders(spark: SparkSession, sf_dir: str, customer: bool = True) -> DataFrame:
    lines = retail_lines(table(spark, sf_dir, "lineitem"))
    if not customer:
        return lines
    return with_customer(lines, table(spark, sf_dir, "orders")).select(*RAW_ORDER_COLUMNS)


def retail_order_log(spark: SparkSession, sf_dir: str, customer: bool = True) -> DataFrame:
    """A change log of raw orders: one commit per shipping day, its lines in order-key order."""
    flag = F.col("l_returnflag")
    logged = table(spark, sf_dir, "lineitem").select(
        *_line_columns(),
        F.when(flag == "R", "DELETE").when(flag == "A", "UPDATE").otherwise("INSERT").alias("op"),
        F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("long").alias("seq"),
        F.col("l_shipdate").alias("commit_ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"),
    )
    if not customer:
        return logged
    return with_customer(logged, table(spark, sf_dir, "orders")).select(
        *RAW_ORDER_COLUMNS, "op", "seq", "commit_ts", "row_no"
    )


def retail_customers(spark: SparkSession, sf_dir: str, city: bool = True) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    columns = [
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower("c_mktsegment"), F.lit("@example.com")).alias("email"),
    ]
    if not city:
        return customer.select(*columns)
    placed = _with_nation(customer, "c_nationkey", table(spark, sf_dir, "nation"))
    return placed.select(*columns, F.col("n_name").alias("city"))


def retail_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        _amount("p_retailprice").alias("unit_price"),
    )


def retail_stores(spark: SparkSession, sf_dir: str, location: bool = True) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    columns = [F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name")]
    if not location:
        return supplier.select(*columns)
    placed = _with_nation(supplier, "s_nationkey", table(spark, sf_dir, "nation"))
    return placed.select(*columns, F.col("n_name").alias("location"))


# Personal finance.


def transaction_lines(lineitem: DataFrame) -> DataFrame:
    """Raw transactions without description and category, which belong to the part."""
    is_credit = F.col("l_returnflag") == "N"
    price = F.col("l_extendedprice")
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.to_date("l_shipdate").alias("txn_date"),
        F.when(is_credit, price).otherwise(-price).cast(DecimalType(10, 2)).alias("amount"),
        F.when(is_credit, "CREDIT").otherwise("DEBIT").alias("type"),
        F.col("l_partkey").alias("part_id"),
    )


def with_merchant(lines: DataFrame, part: DataFrame) -> DataFrame:
    merchants = part.select(
        F.col("p_partkey").alias("part_id"),
        F.concat(F.upper("p_name"), F.lit(" "), "p_brand").alias("description"),
        F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("category"),
    )
    return lines.join(merchants, "part_id", "left").select(
        "transaction_id", "txn_date", "description", "amount", "type", "category"
    )


def transactions_raw(spark: SparkSession, sf_dir: str, merchant: bool = True) -> DataFrame:
    lines = transaction_lines(table(spark, sf_dir, "lineitem"))
    if not merchant:
        return lines.drop("part_id")
    return with_merchant(lines, table(spark, sf_dir, "part"))


# Agriculture.


def crop_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    growers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "n_name"
    )
    return orders.join(growers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("crop_id"),
        F.col("c_mktsegment").alias("crop_name"),
        F.col("n_name").alias("district"),
        F.year("o_orderdate").alias("year"),
        _amount("o_totalprice").alias("production_tonnes"),
    )


def _supplier_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = (table(spark, sf_dir, t) for t in ("supplier", "nation"))
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_acctbal", "n_name"
    )


def rainfall_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Line items are reduced to one row per supplier and year before the district is looked up.
    wettest = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.year("l_shipdate").alias("year"))
        .agg(F.max("l_quantity").cast(AMOUNT).alias("rainfall_mm"))
    )
    places = _supplier_districts(spark, sf_dir).select("s_suppkey", "n_name")
    return wettest.join(places, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").alias("record_id"),
        F.col("n_name").alias("district"),
        "year",
        "rainfall_mm",
    )


def soil_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplier_districts(spark, sf_dir).select(
        F.col("s_suppkey").alias("soil_id"),
        F.lower("n_name").alias("district"),
        _amount("s_acctbal").alias("ph_level"),
    )


def fertilizer_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_returnflag")
        .agg(F.sum(_amount("l_quantity")).alias("quantity"))
    )
    places = _supplier_districts(spark, sf_dir).select("s_suppkey", "n_name")
    return (
        used.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            F.col("n_name").alias("district"), F.col("l_returnflag").alias("fertilizer_type")
        )
        .agg(F.sum("quantity").cast(AMOUNT).alias("quantity_used_kg"))
    )


def farmer_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = (table(spark, sf_dir, t) for t in ("customer", "nation"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("farmer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("district"),
    )


# Usage metering and the change log.


def metering_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("start_time"),
        F.col("event_type").alias("warehouse_name"),
        _amount("value").alias("credits_used"),
    )


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("pk"),
        _amount("value").alias("val"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("commit_ts"),
        F.when(kind == "signup", "INSERT")
        .when(kind == "error", "DELETE")
        .otherwise("UPDATE")
        .alias("op"),
    )
