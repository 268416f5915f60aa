"""The district summary kept up to date from changes of its five tables.

The summary is defined over a join of crops with rainfall, soil, fertilizer and farmers that repeats rows; it can be
told from each table's sums and counts per join key. These are kept as states, one table for each side:

* crops by district, crop and year; rainfall by district and year; soil and fertilizer by district;
* farmers by district and farmer, with how many rows there are of each, because a farmer counts once however many
  rows there are and goes only with the last; from these, how many farmers each part of a district has.

Logged changes of any side are reduced to one signed row per key and added to that side's state. A key is gone when
its rows are. The summary and the KPI table are then worked out again for the touched districts only, from the
states. No table of any side is read, and no state of a side is written that has no changes.

All tables are in buckets by district (the farmers by district and farmer, so that a large district is spread), and
a batch rewrites only the buckets it touches. Every step is repeatable under the label of its batch.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, LongType, StringType, StructField, StructType

from ledgerline.operators.changes import OP, _sign
from ledgerline.plans import agriculture
from ledgerline.session import stored
from ledgerline.sources import buckets
from ledgerline.sources.tables import create_in_buckets, fold_table, stored_rows
from ledgerline.streaming.tasks import Task

CROPS, RAINFALL, SOIL, FERTILIZER, FARMERS = "crops", "rainfall", "soil", "fertilizer", "farmers"
#: The measure of each side, if it has one, and what its rows are counted by beside the district's join key.
SIDES = {
    CROPS: ("production_tonnes", ("district", "crop_name", "year")),
    RAINFALL: ("rainfall_mm", ("year",)),
    SOIL: ("ph_level", ()),
    FERTILIZER: ("quantity_used_kg", ()),
    FARMERS: (None, ("farmer_id",)),
}
KEY, SIDE, ROWS, VALUES, TOTAL, PART = "k", "side", "row_count", "value_count", "total", "part"
_KEYS = ("district", "crop_name", "year", "farmer_id")
COUNTS, SUMMARY, KPI = "farmer_counts", "district_summary", "agri_kpi"


def _join_key(ci: bool) -> Column:
    return F.upper("district") if ci else F.col("district")


def side_changes(side: str, changes: DataFrame, scale: int = 2) -> DataFrame:
    """Changes of one side in the form that all sides share, so that they make one stream.

    ``changes`` has an ``op``; an UPDATE must come as a DELETE and an INSERT.
    """
    measure, keys = SIDES[side]
    amount = F.lit(None) if measure is None else F.col(measure)
    wanted = {*keys, "district"}
    shared = [(F.col(c) if c in wanted else F.lit(None)).cast("string").alias(c) for c in _KEYS]
    return changes.select(F.lit(side).alias(SIDE), *shared, amount.cast(DecimalType(38, scale)).alias(TOTAL), OP)


def signed(changes: DataFrame, ci: bool = True) -> DataFrame:
    """One row per side and key: its rows, its values and their total, deleted ones negative.

    Rows of the other sides that can match no crop, without a district or for rainfall without a year, are left out.
    """
    sign = _sign(changes, OP)
    matching = F.col("district").isNotNull() & ((F.col(SIDE) != RAINFALL) | F.col("year").isNotNull())
    keyed = changes.where((F.col(SIDE) == CROPS) | matching).withColumn(KEY, _join_key(ci))
    # Only crops keep the district's own spelling; of the others all spellings of a join key are one.
    keyed = keyed.withColumn("district", F.when(F.col(SIDE) == CROPS, F.col("district")))
    return keyed.groupBy(SIDE, KEY, *_KEYS).agg(
        F.sum(sign.cast("long")).alias(ROWS),
        F.sum(F.when(F.col(TOTAL).isNotNull(), sign).otherwise(0).cast("long")).alias(VALUES),
        F.sum(F.when(sign > 0, F.col(TOTAL)).otherwise(-F.col(TOTAL))).alias(TOTAL),
    )


def _added(rows: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    both = rows.unionByName(delta).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (ROWS, VALUES, TOTAL)])
    return both.where((F.col(ROWS) != 0) | (F.col(VALUES) != 0))


class DistrictState:
    """The states, the summary and the KPI table, as tables of one schema."""

    def __init__(self, spark: SparkSession, schema: str, ci: bool = True, scale: int = 2, count: int = buckets.BUCKETS):
        self.spark = spark
        self.schema = schema
        self.ci = ci
        self.scale = scale
        self.count = count

    def _table(self, name: str) -> str:
        return f"{self.schema}.{name}" if name in (SUMMARY, KPI) else f"{self.schema}.state_{name}"

    def _keys(self, side: str) -> list[str]:
        return [KEY, *SIDES[side][1]]

    def create(self) -> None:
        """The empty tables."""
        amount, count = DecimalType(38, self.scale), LongType()

        def table(name: str, by: list[str], **columns: DataType) -> None:
            schema = StructType([StructField(c, t) for c, t in columns.items()])
            create_in_buckets(self.spark, self._table(name), schema, by, self.count)

        for side in SIDES:
            by = [KEY, "farmer_id"] if side == FARMERS else [KEY]
            keys = {c: StringType() for c in self._keys(side)}
            table(side, by, **keys, **{ROWS: count, VALUES: count, TOTAL: amount})
        table(COUNTS, [KEY], **{KEY: StringType(), PART: count, "farmer_rows": count, "farmer_ids": count})
        # What the definition gives is kept in the types it gives.
        result = self._summary(lambda side: stored_rows(self.spark, self._table(side)))
        table(SUMMARY, [KEY], **{KEY: StringType()}, **{f.name: f.dataType for f in result.schema if f.name != KEY})
        kpi = agriculture.agri_kpi(result)
        table(KPI, [KEY], **{KEY: StringType()}, **{f.name: f.dataType for f in kpi.schema})

    def apply(self, changes: DataFrame, label: str) -> None:
        """Brings all tables up to date with changes as :func:`side_changes` gives them."""
        delta = stored(signed(changes, self.ci), "district-delta")
        sides = [r[0] for r in delta.select(SIDE).distinct().collect()]  # five at most
        with ThreadPoolExecutor(len(SIDES)) as jobs:  # the sides' tables have nothing to do with each other
            list(jobs.map(lambda side: self._fold_side(side, delta.where(F.col(SIDE) == side), label), sorted(sides)))
        touched = delta.select(KEY).distinct()
        if touched.isEmpty():
            return
        how = buckets.layout(self.spark, self._table(SUMMARY))
        numbers = buckets.touched_buckets(touched, how)

        def state(side: str) -> DataFrame:
            return buckets.in_buckets(self.spark, self._table(side), numbers)

        # All of these are bucketed by the district in the same number of buckets, so the same ones are touched.
        fold_table(self.spark, self._table(SUMMARY), touched, lambda _: self._summary(state), label)
        fold_table(self.spark, self._table(KPI), touched, lambda _: self._kpi(state(SUMMARY)), label)

    def _fold_side(self, side: str, delta: DataFrame, label: str) -> None:
        own = delta.select(*self._keys(side), ROWS, VALUES, TOTAL)
        parts = fold_table(self.spark, self._table(side), own, lambda rows: _added(rows, own, self._keys(side)), label)
        if side == FARMERS:
            self._count_farmers(own, parts, label)

    def _count_farmers(self, delta: DataFrame, parts: list[int], label: str) -> None:
        """Counts farmers again in the touched parts of the changed districts."""
        changed = delta.select(KEY).distinct()
        rows = buckets.in_buckets(self.spark, self._table(FARMERS), parts)
        part = buckets.layout(self.spark, self._table(FARMERS)).bucket().cast("long")
        counted = rows.join(changed, KEY, "left_semi").groupBy(KEY, part.alias(PART)).agg(
            F.sum(ROWS).alias("farmer_rows"), F.count("farmer_id").alias("farmer_ids")
        )

        def step(present: DataFrame) -> DataFrame:
            again = changed.withColumn("again", F.lit(True))
            kept = present.join(again, KEY, "left").where(F.col("again").isNull() | ~F.col(PART).isin(*parts))
            return kept.drop("again").unionByName(counted)

        fold_table(self.spark, self._table(COUNTS), changed, step, label)

    def _summary(self, state: Callable[[str], DataFrame]) -> DataFrame:
        def reduced(side: str, rows: str, values: str, total: str) -> DataFrame:
            measured = F.when(F.col(VALUES) != 0, F.col(TOTAL))  # a SUM without values is NULL
            return state(side).select(KEY, *SIDES[side][1], F.col(ROWS).alias(rows), F.col(VALUES).alias(values), measured.alias(total))

        crops = reduced(CROPS, "crop_rows", "crop_values", "production").drop(KEY, "crop_values")
        crops = crops.withColumn("crop_rows", F.col("crop_rows").cast("decimal(38,0)"))
        rain = reduced(RAINFALL, "rain_rows", "rain_values", "rain_sum").withColumnRenamed("year", "rain_year")
        soil = reduced(SOIL, "soil_rows", "ph_values", "ph_sum")
        fertilizer = reduced(FERTILIZER, "fertilizer_rows", "fertilizer_values", "fertilizer_sum").drop("fertilizer_values")
        farmers = state(COUNTS).groupBy(KEY).agg(F.sum("farmer_rows").alias("farmer_rows"), F.sum("farmer_ids").alias("farmer_ids"))
        with_rain = agriculture.beside_rain(crops, rain, self.ci)
        summary = agriculture.summary_of_sides(with_rain, (soil, fertilizer, farmers), self.ci)
        return summary.withColumn(KEY, _join_key(self.ci))

    def _kpi(self, summary: DataFrame) -> DataFrame:
        return agriculture.agri_kpi(summary).withColumn(KEY, _join_key(self.ci))

    def summary(self) -> DataFrame:
        """The district summary as of the last batch."""
        return stored_rows(self.spark, self._table(SUMMARY)).drop(KEY)

    def kpi(self) -> DataFrame:
        """The KPI table as of the last batch."""
        return stored_rows(self.spark, self._table(KPI)).drop(KEY)


def maintain_districts(
    name: str, state: DistrictState, changes: dict[str, DataFrame], checkpoint: str, lag: str | None = None, **options
) -> Task:
    """A task that follows the change streams of all sides and keeps the tables of ``state`` up to date."""
    streams = [side_changes(side, stream, state.scale) for side, stream in changes.items()]
    return Task(name, reduce(DataFrame.unionByName, streams), state.apply, checkpoint, lag, **options)
