"""A key that owns a third of all rows must not put them into one task."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.changes import apply_changes, latest_images, split_updates
from ledgerline.plans import customers, retail
from ledgerline.session import shared_dir
from ledgerline.sources import testdata as src

ROWS = 120_000


@contextmanager
def large_tables(spark):
    """Settings under which these tables are as far beyond the limits as large ones are by default."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def hot(name, others):
    """Key 7 for a third of the rows, a different third for each column."""
    noise = F.abs(F.xxhash64("id", F.lit(name)))
    return F.when(noise % 3 == 0, 7).otherwise(noise % others).alias(name)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "facts")
    spark.range(0, ROWS, 1, 8).select(
        F.col("id").alias("order_id"),
        hot("customer_id", 2000),
        hot("product_id", 2000),
        hot("store_id", 2000),
        (F.xxhash64("id") % 1000).alias("sales_amount"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias(
            "order_date"
        ),
    ).write.parquet(path)
    return spark.read.parquet(path)


def names(spark, kind):
    return spark.range(2000).select(
        F.col("id").alias(f"{kind}_id"), F.concat(F.lit(kind), F.col("id")).alias(f"{kind}_name")
    )


def dims(spark):
    return [names(spark, kind) for kind in ("customer", "product", "store")]


def test_star_join_splits_hot_keys(spark, facts):
    with large_tables(spark):
        view = retail.sales_view(facts, *dims(spark))
        plan = final_plan(view)
        assert plan.count("SortMergeJoin(skew=true)") == 3
        assert view.count() == ROWS


def test_customer_count_splits_hot_keys(spark, facts):
    with large_tables(spark):
        counts = retail.customer_orders(facts, *dims(spark))
        assert final_plan(counts).count("SortMergeJoin(skew=true)") == 2
        assert counts.agg(F.sum("total_orders")).first()[0] == ROWS


def test_input_lookups_split_hot_keys(spark, facts):
    part = spark.range(2000).selectExpr("id p_partkey", "string(id) p_name", "'b' p_brand", "'t' p_type")
    lines = facts.selectExpr(
        "order_id transaction_id", "order_date txn_date", "sales_amount amount", "'DEBIT' type",
        "product_id part_id",
    )
    with large_tables(spark):
        joined = src.with_merchant(lines, part)
        assert "SortMergeJoin(skew=true)" in final_plan(joined)
        assert joined.count() == ROWS


def shuffled_rows(spark, df):
    """Rows written to shuffles, from the plan's own metrics."""
    df.collect()
    total = 0

    def walk(node):
        nonlocal total
        metrics = node.metrics()
        if "Exchange" in node.nodeName() and metrics.contains("shuffleRecordsWritten"):
            total += metrics.apply("shuffleRecordsWritten").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return total


def test_sums_ship_one_row_per_key_and_task(spark, facts):
    products = names(spark, "product")
    people = names(spark, "customer").withColumnRenamed("customer_name", "name").withColumn(
        "city", F.lit("x")
    )
    orders = facts.withColumnRenamed("sales_amount", "amount")
    tasks = facts.rdd.getNumPartitions()
    for report in (
        retail.product_sales(facts, products),
        customers.customer_summary(people, orders),
        retail.sales_summary(facts),
    ):
        assert 0 < shuffled_rows(spark, report) <= 2000 * (tasks + 3)


def test_latest_images_ship_one_row_per_key_and_task(spark, facts):
    log = facts.selectExpr(
        "product_id pk", "sales_amount v", "'UPDATE' op", "order_id seq", "current_timestamp() commit_ts"
    )
    tasks = facts.rdd.getNumPartitions()
    assert 0 < shuffled_rows(spark, latest_images(log, "pk")) <= 2000 * tasks
    target = spark.range(2000).selectExpr("id pk", "0L v")
    assert apply_changes(target, log, "pk").count() == 2000


def test_recent_sales_spread_a_hot_date(spark, facts):
    one_day = facts.withColumn("order_date", F.lit("2026-01-01").cast("date"))
    with large_tables(spark):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            sizes = (
                retail.recent_sales(one_day, *dims(spark))
                .groupBy(F.spark_partition_id())
                .count()
                .collect()
            )
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < ROWS / 4


def test_changes_of_a_hot_key_are_put_in_order_by_many_tasks(spark):
    """A third of all changes belong to one key: no range, and so no window, has much more than its share of them."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("key"),
        F.col("id").alias("v"), F.lit("UPDATE").alias("op"), F.col("id").alias("seq"),
    )
    split = split_updates(rows, "key", 16)
    plan = split._jdf.queryExecution().analyzed().toString()
    path = re.search(r"log-ranges-[0-9a-f]+", " ".join(split.inputFiles())).group(0)
    sizes = spark.read.parquet(f"{shared_dir(spark)}/{path}").groupBy("_range").count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 2 * 30_000 / 16
    assert "windowspecdefinition(_range" in plan
    own = rows.where("key = 7").count()
    assert own > 10_000 and split.where("key = 7").count() == 2 * own - 1
