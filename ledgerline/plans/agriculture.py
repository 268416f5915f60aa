"""Agriculture: the district summary and the KPI reports on top of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import kpi
from ledgerline.functions.kpi import average
from ledgerline.functions.ordering import descending

SUMMARY_COLUMNS = (
    "district",
    "crop_name",
    "total_production",
    "avg_rainfall",
    "avg_ph",
    "fertilizer_used",
    "total_farmers",
)


def _join_key(ci: bool) -> Column:
    return F.upper("district") if ci else F.col("district")


def _per_district(df: DataFrame, ci: bool, *aggregates: Column) -> DataFrame:
    """One row per join key; rows without a district can never match and are left out."""
    return (
        df.where(F.col("district").isNotNull())
        .groupBy(_join_key(ci).alias("k"))
        .agg(*aggregates)
    )


def _rain_per_year(rainfall: DataFrame, ci: bool) -> DataFrame:
    return (
        rainfall.where(F.col("district").isNotNull() & F.col("year").isNotNull())
        .groupBy(_join_key(ci).alias("k"), F.col("year").alias("rain_year"))
        .agg(
            F.count("*").alias("rain_rows"),
            F.count("rainfall_mm").alias("rain_values"),
            F.sum("rainfall_mm").alias("rain_sum"),
        )
    )


def _soil(soil: DataFrame, ci: bool) -> DataFrame:
    return _per_district(
        soil,
        ci,
        F.count("*").alias("soil_rows"),
        F.count("ph_level").alias("ph_values"),
        F.sum("ph_level").alias("ph_sum"),
    )


def _fertilizer(fertilizer: DataFrame, ci: bool) -> DataFrame:
    return _per_district(
        fertilizer,
        ci,
        F.count("*").alias("fertilizer_rows"),
        F.sum("quantity_used_kg").alias("fertilizer_sum"),
    )


def _farmers(farmers: DataFrame, ci: bool) -> DataFrame:
    # The distinct count is spread over (district, farmer) first, so a large district is no hot spot.
    return _per_district(
        farmers,
        ci,
        F.count("*").alias("farmer_rows"),
        F.count_distinct("farmer_id").alias("farmer_ids"),
    )


def _crops_with_rain(crops: DataFrame, rainfall: DataFrame, ci: bool) -> DataFrame:
    """Crops per district, crop and year beside the rainfall of that district and year, if any."""
    # Row counts are multiplied further on; as decimals they may pass 2^63.
    yearly = crops.groupBy("district", "crop_name", "year").agg(
        F.count("*").cast("decimal(38,0)").alias("crop_rows"),
        F.sum("production_tonnes").alias("production"),
    )
    return beside_rain(yearly, _rain_per_year(rainfall, ci), ci)


def beside_rain(yearly: DataFrame, rain: DataFrame, ci: bool) -> DataFrame:
    """Crops by district, crop and year beside the rainfall of that district and year."""
    same = (_join_key(ci) == rain["k"]) & (F.col("year") == F.col("rain_year"))
    return yearly.join(rain, same, "left").drop("k", "rain_year")


def _with_district_sides(
    by_crop: DataFrame, soil: DataFrame, fertilizer: DataFrame, farmers: DataFrame, ci: bool
) -> DataFrame:
    return _beside_sides(by_crop, (_soil(soil, ci), _fertilizer(fertilizer, ci), _farmers(farmers, ci)), ci)


def _beside_sides(by_crop: DataFrame, sides: Sequence[DataFrame], ci: bool) -> DataFrame:
    keyed = by_crop.withColumn("k", _join_key(ci))
    for side in sides:
        keyed = keyed.join(side, "k", "left")
    return keyed


def _copies(name: str) -> Column:
    """How often a left join repeats a row: once per match, and once without any."""
    return F.coalesce(F.col(name), F.lit(1).cast("long"))


def _times(total: Column, *factors: Column) -> Column:
    return reduce(mul, factors, total)


def district_summary(
    crops: DataFrame,
    rainfall: DataFrame,
    soil: DataFrame,
    fertilizer: DataFrame,
    farmers: DataFrame,
    ci: bool = True,
) -> DataFrame:
    """Production, rainfall, soil, fertilizer and farmers per district and crop.

    The values are those of ``crops LEFT JOIN rainfall LEFT JOIN soil LEFT JOIN fertilizer LEFT JOIN
    farmers`` grouped by (district, crop): every SUM counts a row once per combination of matches on
    the other sides. That join grows with the product of the five tables. Here each table is reduced
    to one row per join key first, and the number of rows it would have contributed multiplies the
    sums instead; no join repeats a row.

    ``ci`` joins districts regardless of case (grouping keeps the spelling); otherwise exactly.

    Totals are decimals at every size, and one beyond 38 digits raises, as it does in the declared
    number type; :func:`district_summary_deduplicated` has the totals without the repetition.
    """
    sides = (_soil(soil, ci), _fertilizer(fertilizer, ci), _farmers(farmers, ci))
    return summary_of_sides(_crops_with_rain(crops, rainfall, ci), sides, ci)


def summary_of_sides(with_rain: DataFrame, sides: Sequence[DataFrame], ci: bool = True) -> DataFrame:
    """:func:`district_summary` from tables that are reduced to one row per join key."""
    by_crop = (
        with_rain
        .groupBy("district", "crop_name")
        .agg(
            F.sum(F.col("production") * _copies("rain_rows")).alias("production"),
            F.sum(F.col("crop_rows") * _copies("rain_rows")).alias("crop_rain_rows"),
            F.sum(F.col("crop_rows") * F.col("rain_sum")).alias("rain_sum"),
            F.sum(F.col("crop_rows") * F.col("rain_values")).alias("rain_values"),
        )
    )
    keyed = _beside_sides(by_crop, sides, ci)
    # Soil, fertilizer and farmer matches are the same for all rows of a group: they cancel in the
    # averages and are plain factors in the sums.
    return keyed.select(
        "district",
        "crop_name",
        _times(
            F.col("production"),
            _copies("soil_rows"),
            _copies("fertilizer_rows"),
            _copies("farmer_rows"),
        ).alias("total_production"),
        average(F.col("rain_sum"), F.col("rain_values")).alias("avg_rainfall"),
        average(F.col("ph_sum"), F.col("ph_values")).alias("avg_ph"),
        _times(
            F.col("fertilizer_sum"),
            F.col("crop_rain_rows"),
            _copies("soil_rows"),
            _copies("farmer_rows"),
        ).alias("fertilizer_used"),
        F.coalesce("farmer_ids", F.lit(0).cast("long")).alias("total_farmers"),
    )


def district_summary_deduplicated(
    crops: DataFrame,
    rainfall: DataFrame,
    soil: DataFrame,
    fertilizer: DataFrame,
    farmers: DataFrame,
    ci: bool = True,
) -> DataFrame:
    """The same columns with true totals: each measure is taken once from its own table.

    Production is the plain sum of the group's crops, rainfall is averaged over the records of the
    district in the years the crop was grown, and fertilizer is the district's total.
    """
    by_crop = (
        _crops_with_rain(crops, rainfall, ci)
        .groupBy("district", "crop_name")
        .agg(
            F.sum("production").alias("total_production"),
            average(F.sum("rain_sum"), F.sum("rain_values")).alias("avg_rainfall"),
        )
    )
    keyed = _with_district_sides(by_crop, soil, fertilizer, farmers, ci)
    return keyed.withColumns(
        {
            "avg_ph": average(F.col("ph_sum"), F.col("ph_values")),
            "fertilizer_used": F.col("fertilizer_sum"),
            "total_farmers": F.coalesce("farmer_ids", F.lit(0).cast("long")),
        }
    ).select(*SUMMARY_COLUMNS)


def crop_rainfall(crops: DataFrame, rainfall: DataFrame) -> DataFrame:
    """``crops LEFT JOIN rainfall`` on district and year, per district, crop and year.

    As in :func:`district_summary`, production counts once per matching rainfall record, and both
    sides are reduced to one row per join key before they meet.
    """
    return _crops_with_rain(crops, rainfall, ci=False).select(
        "district",
        "crop_name",
        "year",
        (F.col("crop_rows") * _copies("rain_rows")).cast("long").alias("joined_rows"),
        (F.col("production") * _copies("rain_rows")).alias("total_production"),
        average(F.col("rain_sum"), F.col("rain_values")).alias("avg_rainfall"),
    )


def agri_kpi(summary: DataFrame) -> DataFrame:
    """Per district: summed production, unweighted mean of the crops' averages, summed farmers."""
    return summary.groupBy("district").agg(
        F.sum("total_production").alias("total_production"),
        F.avg("avg_rainfall").alias("avg_rainfall"),
        F.sum("total_farmers").alias("total_farmers"),
    )


def agri_kpi_dashboard(kpis: DataFrame) -> DataFrame:
    """The headline row: figures rounded to 2 digits and whole counts."""
    return kpis.agg(
        kpi.rounded(F.sum("total_production")).alias("total_production"),
        kpi.rounded(F.avg("avg_rainfall")).alias("avg_rainfall"),
        F.sum("total_farmers").cast("long").alias("total_farmers"),
        F.count_distinct("district").alias("total_districts"),
    )


def _ranked(summary: DataFrame, by: str, value: Column, name: str) -> DataFrame:
    return summary.groupBy(by).agg(value.alias(name)).orderBy(descending(name), by)


def crop_production(summary: DataFrame) -> DataFrame:
    return _ranked(summary, "crop_name", F.sum("total_production"), "production")


def rainfall_by_district(summary: DataFrame) -> DataFrame:
    return _ranked(summary, "district", F.avg("avg_rainfall"), "rainfall")


def soil_ph_by_district(summary: DataFrame) -> DataFrame:
    return _ranked(summary, "district", F.avg("avg_ph"), "ph_level")


def fertilizer_by_district(summary: DataFrame) -> DataFrame:
    used = F.sum("fertilizer_used")
    return _ranked(summary, "district", used, "fertilizer_used")
