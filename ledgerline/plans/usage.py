"""Usage metering reports over (start_time, warehouse_name, credits_used)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.ordering import descending

# The credit limit of the usage monitor and the share at which it acts.
CREDIT_QUOTA = 10
SUSPEND_AT_PERCENT = 100


def _day(day: dt.date | str | None) -> Column:
    return F.current_date() if day is None else F.lit(str(day)).cast("date")


def usage_on(metering: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """Rows of one day (default today) as a half-open range, which the scan can push down."""
    start = _day(day)
    return metering.where(
        (F.col("start_time") >= start) & (F.col("start_time") < F.date_add(start, 1))
    )


def _used(name: str) -> Column:
    return F.sum("credits_used").alias(name)


def total_for_day(metering: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    return (
        usage_on(metering, day)
        .agg(_used("total_credits_used"))
        .select(_day(day).alias("usage_date"), "total_credits_used")
    )


def by_warehouse_for_day(metering: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    return (
        usage_on(metering, day)
        .groupBy("warehouse_name")
        .agg(_used("credits_used"))
        .orderBy(descending("credits_used"), "warehouse_name")
    )


def since_day(
    metering: DataFrame, warehouse: str, day: dt.date | str | None = None
) -> DataFrame:
    return (
        metering.where(
            (F.col("warehouse_name") == warehouse) & (F.col("start_time") >= _day(day))
        )
        .groupBy("warehouse_name")
        .agg(_used("credits_used_today"))
    )


def _of_warehouse(metering: DataFrame, warehouse: str | None) -> DataFrame:
    return metering if warehouse is None else metering.where(F.col("warehouse_name") == warehouse)


def _daily(metering: DataFrame) -> DataFrame:
    return metering.groupBy(F.to_date("start_time").alias("usage_date"), "warehouse_name").agg(
        _used("credits_used")
    )


def by_day(metering: DataFrame, warehouse: str | None = None) -> DataFrame:
    return _daily(_of_warehouse(metering, warehouse)).orderBy(
        descending("usage_date"), "warehouse_name"
    )


def by_warehouse(metering: DataFrame, warehouse: str | None = None) -> DataFrame:
    return (
        _of_warehouse(metering, warehouse)
        .groupBy("warehouse_name")
        .agg(_used("total_credits_used"))
    )


def quota_breach(
    metering: DataFrame, quota: float = CREDIT_QUOTA, percent: float = SUSPEND_AT_PERCENT
) -> DataFrame:
    """Use per warehouse and day, its running total and whether that has reached the credit limit.

    The running total is taken over the daily sums, so a warehouse's window holds one row per day
    however many metering rows there are.
    """
    history = (
        Window.partitionBy("warehouse_name")
        .orderBy("usage_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = _daily(metering).withColumn(
        "cumulative_credits", F.sum("credits_used").over(history)
    )
    limit = F.lit(quota * percent / 100).cast("decimal(38,2)")
    return running.withColumn("breached", F.col("cumulative_credits") >= limit)
