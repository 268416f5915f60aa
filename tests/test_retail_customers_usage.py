import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.masking import AMOUNT_MASK, EMAIL_MASK, mask
from ledgerline.operators.joins import COUNT, SUM, aggregate_by_lookup
from ledgerline.plans import customers, registry, retail, usage
from ledgerline.plans.report import CachedReport, _place, report_pages, to_report


@pytest.fixture
def star(spark):
    """Dimensions with a repeated key, a missing one and shared names; facts with NULL keys."""
    facts = spark.createDataFrame(
        [
            (1, 1, 1, 1, 2, 10, dt.date(2026, 1, 1)),
            (2, 1, 2, 1, 1, 20, dt.date(2026, 1, 2)),
            (3, 2, 2, 2, 1, None, None),
            (4, 9, 1, 1, 1, 40, dt.date(2026, 1, 1)),
            (5, 2, 9, 1, 1, 50, dt.date(2026, 1, 1)),
            (6, None, 1, None, 1, 60, dt.date(2026, 1, 3)),
            (7, 3, 1, 2, 1, 70, dt.date(2025, 1, 1)),
        ],
        "order_id long, customer_id long, product_id long, store_id long, qty long, sales_amount long, order_date date",
    )
    people = spark.createDataFrame([(1, "Ann"), (2, "Bob"), (3, "Ann")], "customer_id long, customer_name string")
    products = spark.createDataFrame([(1, "pen"), (1, "pen"), (2, "ink")], "product_id long, product_name string")
    stores = spark.createDataFrame([(1, "north"), (2, "south")], "store_id long, store_name string")
    return facts, people, products, stores


VIEW = """
    select c.customer_name, p.product_name, s.store_name, f.sales_amount, f.order_date
    from facts f join people c on f.customer_id = c.customer_id
    join products p on f.product_id = p.product_id
    join stores s on f.store_id = s.store_id"""


def named(star):
    return dict(zip(("facts", "people", "products", "stores"), star))


def test_sales_view_and_counts(star, duck, rows):
    frames = named(star)
    assert rows(retail.sales_view(*star)) == duck(VIEW, **frames)
    assert rows(retail.customer_orders(*star)) == duck(
        f"select customer_name, count(*) from ({VIEW}) group by 1", **frames
    )


def test_recent_sales_are_latest_first(star):
    dates = [r["order_date"] for r in retail.recent_sales(*star).collect()]
    assert dates[0] is None
    assert dates[1:] == sorted(dates[1:], reverse=True)


@pytest.mark.parametrize("report,dim,key,name", [
    (retail.product_sales, "products", "product_id", "product_name"),
    (retail.store_sales, "stores", "store_id", "store_name"),
])
def test_sales_by_dimension(star, duck, rows, report, dim, key, name):
    frames = named(star)
    want = duck(
        f"select d.{name}, sum(f.sales_amount)::bigint from facts f join {dim} d on f.{key} = d.{key} group by 1",
        **frames,
    )
    assert rows(report(frames["facts"], frames[dim])) == want


def test_totals_of_nothing(star):
    empty = star[0].limit(0)
    assert retail.total_sales(empty).first()[0] == 0
    assert retail.total_orders(empty).first()[0] == 0


def test_kpi_row_and_view_by_name(spark, star):
    assert tuple(retail.kpi_row(star[0].selectExpr("sales_amount * 100 as sales_amount")).first()) == (
        "25,000",
        7,
    )
    assert tuple(retail.kpi_row(star[0].limit(0)).first()) == ("0", 0)
    retail.create_view(*star)
    expected = retail.customer_orders(*star).collect()
    found = spark.sql(
        "select customer_name, count(*) as total_orders from sales_view"
        " group by all order by total_orders desc, customer_name"
    )
    assert found.collect() == expected


def test_fact_amount_is_the_price_alone(spark):
    raw = spark.sql("select 1 order_id, '1' customer_id, '1' product_id, '1' store_id, 3 qty, 10 price, date '2026-01-01' order_date")
    fact = retail.build_fact_sales(raw)
    assert fact.columns[5] == "sales_amount" and fact.first()["sales_amount"] == 10
    assert retail.build_dim(raw).first() == raw.first()


def test_fact_load_leaves_deletes_out_unless_as_written(spark):
    changes = spark.sql(
        "select 1 order_id, 10 price, op, 1L seq, current_timestamp() commit_ts"
        " from values ('INSERT'), ('UPDATE'), ('DELETE') as t(op)"
    )
    assert retail.load_fact_sales(changes).count() == 2
    assert retail.load_fact_sales(changes, as_written=True).count() == 3


def test_sales_on(star):
    assert {r["order_id"] for r in retail.sales_on(star[0], "2026-01-01").collect()} == {1, 4, 5}


def test_lookup_measures(spark, duck, rows):
    facts = spark.createDataFrame([(1, 5), (1, None), (2, 7), (None, 9)], "k long, v long")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c")], "k long, g string")
    got = aggregate_by_lookup(
        facts, dim, "k", ["g"], {"rows": (COUNT, "*"), "vals": (COUNT, "v"), "total": (SUM, "v")}
    )
    want = duck(
        "select g, count(*), count(v), sum(v)::bigint from facts join dim using (k) group by g",
        facts=facts, dim=dim,
    )
    assert rows(got) == want
    with pytest.raises(ValueError):
        aggregate_by_lookup(facts, dim, "k", ["g"], {"m": ("max", "v")})


@pytest.fixture
def crm(spark):
    people = spark.createDataFrame(
        [(1, "A", "X"), (2, "A", "Y"), (3, "B", "X"), (4, "idle", "X")],
        "customer_id long, name string, city string",
    )
    orders = spark.createDataFrame(
        [(1, 1, 10), (2, 1, 20), (None, 2, 5), (4, 3, None), (5, 9, 99)],
        "order_id long, customer_id long, amount long",
    )
    return people, orders


def test_customer_summary(crm, rows):
    assert rows(customers.customer_summary(*crm)) == [
        (1, "A", "X", 2, 30),
        (2, "A", "Y", 0, 5),
        (3, "B", "X", 1, None),
    ]


def test_spend_by_name_adds_namesakes_and_puts_null_first(crm):
    spend = customers.spend_by_name(customers.customer_summary(*crm)).collect()
    assert [tuple(r) for r in spend] == [("B", None), ("A", 35)]


@pytest.mark.parametrize("role,total", [("ACCOUNTADMIN", 30), ("DB_ANALYST", 0), ("accountadmin", 0)])
def test_masks_apply_before_the_sum(crm, role, total):
    summary = customers.customer_summary(*crm, role=role)
    assert summary.where("customer_id = 1").first()["total_spent"] == total
    assert summary.where("customer_id = 1").first()["total_orders"] == 2


def test_mask_keeps_names_order_and_types(spark):
    df = spark.sql("select 1 id, cast(2.50 as decimal(18,2)) amount, 'a@b' email")
    seen = mask(df, {"amount": AMOUNT_MASK, "email": EMAIL_MASK}, "ANALYST")
    assert [(f.name, f.dataType) for f in seen.schema] == [(f.name, f.dataType) for f in df.schema]
    assert tuple(seen.first()) == (1, Decimal("0.00"), "*****")
    assert mask(df, {"email": EMAIL_MASK}, "ACCOUNTADMIN").first() == df.first()
    with pytest.raises(ValueError):
        mask(df, {"mail": EMAIL_MASK}, "ANALYST")


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(params=["timestamp", "timestamp_ntz"])
def metering(spark, request):
    rows = [
        (ts("2024-01-14 23:59:59"), "A", Decimal("4.00")),
        (ts("2024-01-15 00:00:00"), "A", Decimal("5.00")),
        (ts("2024-01-15 23:59:59"), "B", Decimal("7.00")),
        (ts("2024-01-16 00:00:00"), "A", Decimal("1.00")),
        (None, "A", Decimal("9.00")),
    ]
    df = spark.createDataFrame(rows, "start_time timestamp, warehouse_name string, credits_used decimal(18,2)")
    return df.withColumn("start_time", df.start_time.cast(request.param))


def test_day_is_half_open(metering, rows):
    total = usage.total_for_day(metering, "2024-01-15").first()
    assert tuple(total) == (dt.date(2024, 1, 15), Decimal("12.00"))
    assert [tuple(r) for r in usage.by_warehouse_for_day(metering, dt.date(2024, 1, 15)).collect()] == [
        ("B", Decimal("7.00")),
        ("A", Decimal("5.00")),
    ]
    assert tuple(usage.total_for_day(metering, "2030-01-01").first())[1] is None


def test_since_day_and_totals(metering, rows):
    assert rows(usage.since_day(metering, "A", "2024-01-15")) == [("A", Decimal("6.00"))]
    assert rows(usage.by_warehouse(metering, "A")) == [("A", Decimal("19.00"))]
    assert usage.by_warehouse(metering).count() == 2
    days = [r["usage_date"] for r in usage.by_day(metering, "A").collect()]
    assert days == [None, dt.date(2024, 1, 16), dt.date(2024, 1, 15), dt.date(2024, 1, 14)]


def test_today_is_the_default(spark):
    df = spark.sql("select current_timestamp() start_time, 'A' warehouse_name, 1 credits_used")
    assert usage.total_for_day(df).first()["total_credits_used"] == 1
    assert usage.since_day(df, "A").count() == 1


def test_quota_breach(metering):
    got = usage.quota_breach(metering.where("start_time is not null"), quota=10, percent=90)
    flags = {(str(r["usage_date"]), r["warehouse_name"]): r["breached"] for r in got.collect()}
    assert flags == {
        ("2024-01-14", "A"): False,
        ("2024-01-15", "A"): True,
        ("2024-01-16", "A"): True,
        ("2024-01-15", "B"): False,
    }


def test_report_is_refused_not_cut(spark):
    assert len(to_report(spark.range(5), max_rows=5)) == 5
    with pytest.raises(ValueError):
        to_report(spark.range(6), max_rows=5)


def test_report_in_pages_is_whole_and_in_order(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(i or None, big + i) for i in range(11)], "a long, b long").repartition(3)
    pages = list(report_pages(df, F.col("b").desc(), page_rows=4))
    assert all(0 < len(page) <= 4 for page in pages) and 3 <= len(pages) <= 6
    assert [tuple(r) for page in pages for r in page.values] == [(i or None, big + i) for i in range(10, -1, -1)]
    (empty,) = report_pages(df.where("b < 0"), "b", page_rows=4)
    assert list(empty.columns) == ["a", "b"] and empty.empty
    names = [f"part-{task}-5c0ffee1-c{number}.snappy.parquet" for task in ("00002", "100000") for number in ("000", "101", "1000")]
    assert sorted(sorted(names), key=_place) == names


def test_report_of_many_partitions_is_few_pages(spark):
    df = spark.range(40).withColumn("x", -F.col("id"))
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, ("23", "false")):
            spark.conf.set(name, value)
        (page,) = report_pages(df, "x", page_rows=40)
        halves = list(report_pages(df, "x", page_rows=20))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert page["x"].tolist() == list(range(-39, 1))
    assert len(halves) <= 4 and [x for half in halves for x in half["x"]] == list(range(-39, 1))


@pytest.mark.parametrize("arrow", ["true", "false"])
def test_report_frame_has_every_product(spark, tmp_path, monkeypatch, arrow):
    """More products than a page holds, one of them NULL and one that no float can tell from its neighbour."""
    products = [None, 2**53 + 1, *range(1, 24)]
    lines = [(i, p, 1, 1.0, 10.25 * i, "1998-01-01") for i, p in enumerate(products * 2)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate string"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setitem(report_pages.__kwdefaults__, "page_rows", 7)
    before = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", arrow)
    try:
        got = registry.queries()["report_frame"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", before)
    want = {p: 10.25 * i + 10.25 * (i + len(products)) for i, p in enumerate(products)}
    assert len(got) == len(products) and {r["product_id"]: r["total_sales"] for r in got} == want


def test_report_frame_is_of_no_product_without_sales(spark, tmp_path):
    spark.createDataFrame(
        [], "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate string"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert registry.queries()["report_frame"](spark, str(tmp_path)).collect() == []


def test_cached_report_is_rebuilt_when_old(spark):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    report = CachedReport(build, ttl_s=None)
    assert report.get() is report.get() and report.get().count() == 3
    assert len(built) == 1 and report.get().storageLevel.useMemory
    expired = CachedReport(build, ttl_s=-1)
    expired.get(), expired.get()
    assert len(built) == 3
    report.clear(), expired.clear()
