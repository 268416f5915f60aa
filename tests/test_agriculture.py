"""The district summary against the plain four-way join, on data with every awkward case."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import agriculture as agro

JOIN = """
    select c.district, c.crop_name, sum(c.production_tonnes), avg(r.rainfall_mm), avg(s.ph_level),
           sum(f.quantity_used_kg), count(distinct fm.farmer_id)
    from crops c
    left join rain r on {0}(c.district) = {0}(r.district) and c.year = r.year
    left join soil s on {0}(c.district) = {0}(s.district)
    left join fert f on {0}(c.district) = {0}(f.district)
    left join farm fm on {0}(c.district) = {0}(fm.district)
    group by c.district, c.crop_name"""


def make(spark, seed, n=40):
    rnd = random.Random(seed)
    places = ["Pune", "PUNE", "pune", "Latur", "Nashik", "Akola", None]

    def number(digits=2):
        return None if rnd.random() < 0.2 else Decimal(rnd.randint(-999, 9999)).scaleb(-digits)

    def year():
        return rnd.choice([2023, 2024, 2025, None])

    def only(allowed):
        return rnd.choice([p for p in places if p is None or p.upper() in allowed])

    crops = [(i, rnd.choice(["rice", "soy", None]), rnd.choice(places), year(), number()) for i in range(n)]
    rain = [(i, only({"PUNE", "LATUR"}), year(), number()) for i in range(n)]
    soil = [(i, only({"PUNE", "NASHIK"}), number()) for i in range(10)]
    fert = [(i, only({"PUNE", "LATUR", "NASHIK"}), number()) for i in range(10)]
    farm = [(rnd.choice([1, 2, 3, 4, None]), only({"PUNE", "LATUR"})) for _ in range(10)]
    num = "decimal(18,2)"
    return {
        "crops": spark.createDataFrame(crops, f"crop_id long, crop_name string, district string, year long, production_tonnes {num}"),
        "rain": spark.createDataFrame(rain, f"record_id long, district string, year long, rainfall_mm {num}"),
        "soil": spark.createDataFrame(soil, f"soil_id long, district string, ph_level {num}"),
        "fert": spark.createDataFrame(fert, f"fertilizer_id long, district string, quantity_used_kg {num}"),
        "farm": spark.createDataFrame(farm, "farmer_id long, district string"),
    }


def near(a, b):
    if a is None or b is None or isinstance(a, str):
        return a == b
    return abs(float(a) - float(b)) <= 1e-9 * max(1.0, abs(float(b)))


@pytest.mark.parametrize("ci", [True, False])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_summary_equals_the_join(spark, duck, rows, seed, ci):
    frames = make(spark, seed)
    got = rows(agro.district_summary(*frames.values(), ci=ci))
    want = duck(JOIN.format("upper" if ci else ""), **frames)
    by_group = lambda found: sorted(found, key=lambda r: repr(r[:2]))
    got, want = by_group(got), by_group(want)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(near(a, b) for g, w in zip(got, want) for a, b in zip(g, w))


def test_null_district_is_a_group_without_matches(spark):
    frames = make(spark, 1)
    nulls = agro.district_summary(*frames.values()).where("district is null").collect()
    assert nulls and all(r["avg_rainfall"] is None and r["total_farmers"] == 0 for r in nulls)


def test_deduplicated_totals(spark):
    frames = make(spark, 4)
    total = agro.district_summary_deduplicated(*frames.values()).agg({"total_production": "sum"})
    plain = frames["crops"].agg({"production_tonnes": "sum"})
    assert total.first()[0] == plain.first()[0]


def test_no_join_repeats_a_row(spark):
    """Rows after every join stay within the reduced crop table, however many match."""
    frames = make(spark, 5, n=200)
    summary = agro.district_summary(*frames.values())
    groups = frames["crops"].select("district", "crop_name").distinct().count()
    assert summary.count() == groups
    for side in ("rain", "soil", "fert", "farm"):
        frames[side] = frames[side].union(frames[side])
    assert agro.district_summary(*frames.values()).count() == groups


def test_kpi_reports(spark, rows):
    summary = spark.createDataFrame(
        [
            ("a", "x", Decimal("10.00"), 1.0, 6.0, Decimal("1.00"), 2),
            ("a", "y", Decimal("20.00"), 4.0, 7.0, Decimal("2.00"), 2),
            ("b", "x", Decimal("5.55"), None, None, None, 0),
            (None, "x", None, None, None, None, 0),
        ],
        "district string, crop_name string, total_production decimal(38,2), avg_rainfall double,"
        "avg_ph double, fertilizer_used decimal(38,2), total_farmers long",
    )
    kpis = agro.agri_kpi(summary)
    assert rows(kpis) == sorted(
        [("a", Decimal("30.00"), 2.5, 4), ("b", Decimal("5.55"), None, 0), (None, None, None, 0)],
        key=repr,
    )
    assert rows(agro.agri_kpi_dashboard(kpis)) == [(35.55, 2.5, 4, 2)]
    # Descending order puts NULL first.
    ranked = [tuple(r) for r in agro.rainfall_by_district(summary).collect()]
    assert ranked == [(None, None), ("b", None), ("a", 2.5)]
    assert [tuple(r) for r in agro.crop_production(summary).collect()] == [
        ("y", Decimal("20.00")),
        ("x", Decimal("15.55")),
    ]


def test_totals_beyond_38_digits_raise(spark):
    """Repetition by three sides of 300 rows each takes 9e30 past the largest decimal."""
    frames = make(spark, 6)
    copies = spark.range(300).selectExpr("id", "'PUNE' as district", "cast(1 as decimal(18,2)) as v")
    for side, key, measure in (
        ("soil", "soil_id", "ph_level"),
        ("fert", "fertilizer_id", "quantity_used_kg"),
        ("farm", "farmer_id", "land"),
    ):
        frames[side] = copies.selectExpr(f"id as {key}", "district", f"v as {measure}")
    frames["crops"] = frames["crops"].withColumn(
        "production_tonnes", F.lit("9e30").cast("decimal(38,2)")
    )
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|OVERFLOW"):
        agro.district_summary(*frames.values()).collect()


def test_small_fractions_add_up(spark):
    """No addend is rounded before it is summed."""
    summary = spark.range(1000).selectExpr(
        "concat('d', id % 4) as district", "concat('c', id) as crop_name", "cast(0.001 as decimal(38,3)) as total_production", "1.0 as avg_rainfall", "1 as total_farmers"
    )
    kpis = agro.agri_kpi(summary)
    assert {r["total_production"] for r in kpis.collect()} == {Decimal("0.250")}
    assert agro.agri_kpi_dashboard(kpis).first()["total_production"] == 1
    doubles = summary.withColumn("total_production", F.col("total_production").cast("double"))
    assert agro.agri_kpi(doubles).agg(F.sum("total_production")).first()[0] == pytest.approx(1.0)
