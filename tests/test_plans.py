"""What the physical plans must and must not contain."""

import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registry.queries()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

#: Running totals over daily sums, and the row before an update, found per key.
WINDOWS = {"usage_quota_breach", "cdc_net_row_changes", "mv_logged_sums"}
WRITES_FILES = {
    "csv_load_orders",
    "csv_load_rejects",
    "ingest_stream_orders",
    "task_fact_load",
    "task_enrich_transactions",
    "refresh_sales_summary",
    "clustered_sales_on_date",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"FileScan parquet \[(.*?)\].*?ReadSchema: struct<(.*?)>", text)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FILES))
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "InPandas" not in text
    assert ("Window" in text) == (name in WINDOWS)


def test_filters_reach_the_scan(spark):
    for name, column in (
        ("usage_total_for_day", "GreaterThanOrEqual(ts,"),
        ("usage_since_day", "EqualTo(event_type,click)"),
        ("time_travel_as_of", "LessThanOrEqual(ts,"),
        ("cdc_changes", "GreaterThan(event_id,"),
    ):
        assert column in plan(QUERIES[name](spark, SF_DIR)), name


def test_only_needed_columns_are_read(spark):
    def columns(name):
        found = scans(plan(QUERIES[name](spark, SF_DIR)))
        return {c.split(":")[0] for _, schema in found for c in schema.split(",") if c}

    assert columns("total_sales") == {"l_extendedprice"}
    assert columns("dt_sales_summary") == {"l_partkey", "l_extendedprice"}
    assert columns("product_sales") == {"l_partkey", "l_extendedprice", "p_partkey", "p_name"}
    assert "o_totalprice" not in columns("masked_customer_summary")


def without_broadcast(spark, name):
    """The plan when no side may be broadcast, as with tables far beyond the limit."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["product_sales", "store_sales", "customer_summary"])
def test_facts_are_summed_before_they_are_shuffled(spark, name):
    """Reading a plan upwards from a fact scan, a partial aggregate comes before any exchange."""
    text = without_broadcast(spark, name)
    fact = "lineitem" if name != "customer_summary" else "orders"
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and f"{fact}.parquet" in line)
    depth = lines[at].index("FileScan")
    for line in reversed(lines[:at]):
        operator = re.search(r"[A-Z]\w+", line)
        if operator and operator.start() < depth:
            depth = operator.start()
            if "Aggregate" in line:
                assert "partial_" in line
                return
            assert "Exchange" not in line, line
    raise AssertionError("no aggregate above the scan")


def test_top_merchants_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_merchants"](spark, SF_DIR))


def test_net_changes_scan_and_shuffle_once(spark):
    text = plan(QUERIES["cdc_net_changes"](spark, SF_DIR))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text


def test_apply_changes_does_not_shuffle_the_target_for_few_changes(spark, tmp_path):
    from ledgerline.operators.changes import apply_changes

    target_path = str(tmp_path / "target")
    spark.range(1000).select(F.col("id").alias("pk"), F.lit(1).alias("v")).write.parquet(target_path)
    log = spark.createDataFrame(
        [(1, 2, "UPDATE", 1), (5000, 1, "INSERT", 2), (2, 1, "DELETE", 3)],
        "pk long, v int, op string, seq long",
    ).withColumn("commit_ts", F.current_timestamp())
    applied = apply_changes(spark.read.parquet(target_path), log, "pk")
    applied.collect()
    text = plan(applied).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert applied.count() == 1000
