"""Tables compared by content, and counts from file footers."""

import random
from collections import Counter

import pytest

from ledgerline.operators import counts

SCHEMA = "id long, name string, v double"


@pytest.mark.parametrize("seed", range(3))
def test_differences_are_those_of_the_rows(spark, seed):
    rnd = random.Random(seed)
    make = lambda: (rnd.choice([None, *range(40)]), rnd.choice([None, "a", "b"]), rnd.choice([None, 0.5, 1.0]))
    left = [make() for _ in range(150)]
    right = [r for r in left if rnd.random() < 0.95] + [make() for _ in range(6)]
    frames = [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (left, right)]
    found = sorted((tuple(r) for r in counts.content_differences(*frames, "id", 16).collect()), key=repr)
    a, b = Counter(left), Counter(right)
    assert found == sorted(((*r, a[r], b[r]) for r in a.keys() | b.keys() if a[r] != b[r]), key=repr)


def test_equal_tables_in_other_orders_and_types_do_not_differ(spark):
    rows = spark.range(500).selectExpr("id", "CAST(id % 7 AS STRING) AS name", "CAST(id AS DOUBLE) AS v")
    other = rows.selectExpr("v", "CAST(id AS INT) AS id", "name").repartition(5)
    assert counts.content_differences(rows, other, ["id", "name"]).collect() == []
    assert counts.content_differences(rows.limit(0), other.limit(0), "id").collect() == []


def test_only_buckets_that_differ_are_compared(spark):
    rows = spark.range(5000).selectExpr("id", "id AS v")
    changed = rows.selectExpr("id", "IF(id = 77, -1, v) AS v")
    found = counts.content_differences(rows, changed, "id", 64)
    assert sorted(tuple(r) for r in found.collect()) == [(77, -1, 0, 1), (77, 77, 1, 0)]
    assert "pmod" in found._jdf.queryExecution().optimizedPlan().toString()


def test_counts_come_from_footers(spark, tmp_path):
    spark.range(1234).repartition(3).write.parquet(str(tmp_path / "t"))
    counted = counts.count_from_footers(spark, str(tmp_path / "t"))
    assert counted.first().row_count == 1234
    assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
