"""Every report and operator as ``name -> (spark, sf_dir) -> DataFrame`` over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from ledgerline.functions.masking import EMAIL_MASK, UNMASKED_ROLE, mask
from ledgerline.operators import changes as cdc
from ledgerline.operators.counts import reconcile, row_count
from ledgerline.operators.stored_sums import merge_sums, partial_sums, read_sums
from ledgerline.plans import agriculture, customers, finance, retail, usage
from ledgerline.session import stored
from ledgerline.sources import testdata as src

Query = Callable[[SparkSession, str], DataFrame]

READER_ROLE = "ANALYST"
SALES_DAY = "2000-01-01"
USAGE_DAY = "2024-01-15"
USAGE_WAREHOUSE = "click"
USAGE_QUOTA = 5000
AS_OF_TS, AS_OF_OFFSET_S = "2024-01-20 00:00:00", 3600
CHANGES_SINCE, CHANGES_UNTIL = "2024-01-11", "2024-01-21"
FACTS_SINCE = "1998-07-01"
DELETE_BELOW = 200000

#: Stand-ins for the enrichment keywords which occur in the test merchants. They overlap on purpose:
#: ``%old%`` also finds COLD, so matching order and bare substrings matter.
TEST_RULES = (
    ("%red%", "Food"),
    ("%bolt%", "Shopping"),
    ("%old%", "Travel"),
    ("%gizmo%", "Entertainment"),
    ("%ring%", "Investment"),
)

_QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Decimals as doubles and dates as text, so that both engines print equal values."""

    def shown(field):
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        if field.name in digits:
            column = F.round(column, digits[field.name])
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


def register(**digits: int) -> Callable[[Query], Query]:
    """Adds a query under its function's name; ``digits`` rounds averaged columns."""

    def add(build: Query) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain(build(spark, sf_dir), digits)

        query.__name__ = build.__name__
        query.__doc__ = build.__doc__
        _QUERIES[build.__name__] = query
        return build

    return add


def queries() -> dict[str, Query]:
    # Imported here: these queries register themselves and need this module to do so.
    from ledgerline.plans import registry_files  # noqa: F401

    return dict(_QUERIES)


# Retail.


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Facts without the customer, for reports that do not use it."""
    return retail.build_fact_sales(src.retail_orders(spark, d, customer=False))


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return retail.build_fact_sales(src.retail_orders(spark, d))


def _dims(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The dimensions without places, which no sales report shows."""
    return (
        retail.build_dim(src.retail_customers(spark, d, city=False)),
        retail.build_dim(src.retail_product(spark, d)),
        retail.build_dim(src.retail_stores(spark, d, location=False)),
    )


@register()
def fact_sales(spark: SparkSession, d: str) -> DataFrame:
    return _facts(spark, d)


@register()
def dim_stores(spark: SparkSession, d: str) -> DataFrame:
    return retail.build_dim(src.retail_stores(spark, d))


@register()
def sales_view(spark: SparkSession, d: str) -> DataFrame:
    return retail.sales_view(_facts(spark, d), *_dims(spark, d))


@register()
def recent_sales(spark: SparkSession, d: str) -> DataFrame:
    return retail.recent_sales(_facts(spark, d), *_dims(spark, d))


@register()
def total_sales(spark: SparkSession, d: str) -> DataFrame:
    return retail.total_sales(_lines(spark, d))


@register()
def total_orders(spark: SparkSession, d: str) -> DataFrame:
    return retail.total_orders(_lines(spark, d))


@register()
def retail_kpi_row(spark: SparkSession, d: str) -> DataFrame:
    return retail.kpi_row(_lines(spark, d))


@register()
def product_sales(spark: SparkSession, d: str) -> DataFrame:
    return retail.product_sales(_lines(spark, d), src.retail_product(spark, d))


@register()
def store_sales(spark: SparkSession, d: str) -> DataFrame:
    return retail.store_sales(_lines(spark, d), src.retail_stores(spark, d, location=False))


@register()
def customer_orders(spark: SparkSession, d: str) -> DataFrame:
    return retail.customer_orders(_facts(spark, d), *_dims(spark, d))


@register()
def sales_on_date(spark: SparkSession, d: str) -> DataFrame:
    return retail.sales_on(_facts(spark, d), SALES_DAY)


@register()
def dt_sales_summary(spark: SparkSession, d: str) -> DataFrame:
    return retail.sales_summary(_lines(spark, d))


@register()
def mv_product_sales(spark: SparkSession, d: str) -> DataFrame:
    """Stored sums of the facts up to a day, with the later facts merged in."""
    lines = _lines(spark, d)
    day, cut = F.col("order_date"), F.lit(FACTS_SINCE).cast("date")
    stored = partial_sums(lines.where(day < cut), "product_id", "sales_amount")
    later = lines.where((day >= cut) | day.isNull())
    delta = partial_sums(later, "product_id", "sales_amount")
    return read_sums(merge_sums(stored, delta, "product_id"), "product_id")


@register()
def mask_email(spark: SparkSession, d: str) -> DataFrame:
    return mask(src.retail_customers(spark, d), {"email": EMAIL_MASK}, READER_ROLE)


@register()
def limit_sample_check(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a sample, and how many of them are no facts."""
    facts = _lines(spark, d)
    sample = stored(facts.limit(10), "limit-sample")
    # Ten rows: the facts are only scanned for them, not shuffled.
    present = facts.join(F.broadcast(sample.distinct()), facts.columns, "left_semi").distinct()
    found = sample.withColumn("n", F.lit(1)).join(present.withColumn("f", F.lit(1)), facts.columns, "left")
    return found.agg(F.sum("n").alias("sampled"), F.sum(F.coalesce(F.lit(1) - F.col("f"), F.lit(1))).alias("no_facts"))


@register()
def limit_sample(spark: SparkSession, d: str) -> DataFrame:
    """Any ten facts."""
    return _lines(spark, d).limit(10)


# Personal finance.


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return src.transactions_raw(spark, d)


def _transactions(spark: SparkSession, d: str) -> DataFrame:
    return finance.enrich_transactions(_raw(spark, d), TEST_RULES)


def _amounts(spark: SparkSession, d: str) -> DataFrame:
    """Transactions without merchant and category, for reports that do not use them."""
    return src.transactions_raw(spark, d, merchant=False)


@register()
def categorize_transactions(spark: SparkSession, d: str) -> DataFrame:
    return finance.categorize_transactions(_raw(spark, d), TEST_RULES)


@register()
def enrich_transactions(spark: SparkSession, d: str) -> DataFrame:
    return _transactions(spark, d)


@register()
def monthly_expense(spark: SparkSession, d: str) -> DataFrame:
    return finance.monthly_expense(_amounts(spark, d))


@register()
def category_expense(spark: SparkSession, d: str) -> DataFrame:
    return finance.category_expense(_transactions(spark, d))


@register()
def income_expense(spark: SparkSession, d: str) -> DataFrame:
    return finance.income_expense(_amounts(spark, d))


@register()
def income_expense_by_year(spark: SparkSession, d: str) -> DataFrame:
    return finance.income_expense(_amounts(spark, d), by_year=True)


@register()
def merchant_spend(spark: SparkSession, d: str) -> DataFrame:
    return finance.merchant_spend(_transactions(spark, d))


@register()
def top_merchants(spark: SparkSession, d: str) -> DataFrame:
    return finance.top_merchants(_transactions(spark, d))


@register()
def savings(spark: SparkSession, d: str) -> DataFrame:
    return finance.savings(_amounts(spark, d))


@register()
def savings_rate(spark: SparkSession, d: str) -> DataFrame:
    return finance.savings_rate(_amounts(spark, d))


@register()
def financial_health(spark: SparkSession, d: str) -> DataFrame:
    return finance.financial_health(_amounts(spark, d))


@register()
def finance_kpi_row(spark: SparkSession, d: str) -> DataFrame:
    return finance.kpi_row(_amounts(spark, d))


# Customer orders.


def _summary(spark: SparkSession, d: str, role: str | None = None) -> DataFrame:
    return customers.customer_summary(
        src.crm_customers(spark, d), src.crm_orders(spark, d), role
    )


@register()
def scan_orders(spark: SparkSession, d: str) -> DataFrame:
    return src.crm_orders(spark, d)


@register()
def customer_summary(spark: SparkSession, d: str) -> DataFrame:
    return _summary(spark, d)


@register()
def mv_customer(spark: SparkSession, d: str) -> DataFrame:
    return customers.mv_customer(_summary(spark, d))


@register()
def customer_spend_by_name(spark: SparkSession, d: str) -> DataFrame:
    return customers.spend_by_name(_summary(spark, d))


@register()
def mask_amount(spark: SparkSession, d: str) -> DataFrame:
    return customers.masked_orders(src.crm_orders(spark, d), READER_ROLE)


@register()
def mask_amount_admin(spark: SparkSession, d: str) -> DataFrame:
    return customers.masked_orders(src.crm_orders(spark, d), UNMASKED_ROLE)


@register()
def masked_customer_summary(spark: SparkSession, d: str) -> DataFrame:
    return _summary(spark, d, READER_ROLE)


@register()
def delete_where(spark: SparkSession, d: str) -> DataFrame:
    return cdc.keep_after_delete(src.crm_orders(spark, d), F.col("amount") < DELETE_BELOW)


# Agriculture.


def _agro(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    return (
        src.crop_data(spark, d),
        src.rainfall_data(spark, d),
        src.soil_data(spark, d),
        src.fertilizer_data(spark, d),
        src.farmer_data(spark, d),
    )


def _districts(spark: SparkSession, d: str, ci: bool = True) -> DataFrame:
    return agriculture.district_summary(*_agro(spark, d), ci=ci)


@register(avg_rainfall=6)
def crop_rainfall_left(spark: SparkSession, d: str) -> DataFrame:
    return agriculture.crop_rainfall(src.crop_data(spark, d), src.rainfall_data(spark, d))


@register(avg_rainfall=6, avg_ph=6)
def district_summary(spark: SparkSession, d: str) -> DataFrame:
    return _districts(spark, d)


@register(avg_rainfall=6, avg_ph=6)
def district_summary_cs(spark: SparkSession, d: str) -> DataFrame:
    return _districts(spark, d, ci=False)


@register(avg_rainfall=6, avg_ph=6)
def district_summary_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    return agriculture.district_summary_deduplicated(*_agro(spark, d))


@register(avg_rainfall=6)
def agri_kpi(spark: SparkSession, d: str) -> DataFrame:
    return agriculture.agri_kpi(_districts(spark, d))


@register()
def agri_kpi_dashboard(spark: SparkSession, d: str) -> DataFrame:
    return agriculture.agri_kpi_dashboard(agriculture.agri_kpi(_districts(spark, d)))


@register()
def crop_production(spark: SparkSession, d: str) -> DataFrame:
    return agriculture.crop_production(_districts(spark, d))


@register(rainfall=6)
def rainfall_by_district(spark: SparkSession, d: str) -> DataFrame:
    return agriculture.rainfall_by_district(_districts(spark, d))


@register(ph_level=6)
def soil_ph_by_district(spark: SparkSession, d: str) -> DataFrame:
    return agriculture.soil_ph_by_district(_districts(spark, d))


@register()
def fertilizer_by_district(spark: SparkSession, d: str) -> DataFrame:
    return agriculture.fertilizer_by_district(_districts(spark, d))


# Usage metering.


@register()
def usage_total_for_day(spark: SparkSession, d: str) -> DataFrame:
    return usage.total_for_day(src.metering_history(spark, d), USAGE_DAY)


@register()
def usage_by_warehouse_for_day(spark: SparkSession, d: str) -> DataFrame:
    return usage.by_warehouse_for_day(src.metering_history(spark, d), USAGE_DAY)


@register()
def usage_since_day(spark: SparkSession, d: str) -> DataFrame:
    return usage.since_day(src.metering_history(spark, d), USAGE_WAREHOUSE, USAGE_DAY)


@register()
def usage_by_day(spark: SparkSession, d: str) -> DataFrame:
    return usage.by_day(src.metering_history(spark, d), USAGE_WAREHOUSE)


@register()
def usage_by_warehouse(spark: SparkSession, d: str) -> DataFrame:
    return usage.by_warehouse(src.metering_history(spark, d), USAGE_WAREHOUSE)


@register()
def usage_quota_breach(spark: SparkSession, d: str) -> DataFrame:
    return usage.quota_breach(src.metering_history(spark, d), USAGE_QUOTA)


# Change capture.


@register()
def cdc_changes(spark: SparkSession, d: str) -> DataFrame:
    log = src.changelog(spark, d)
    return cdc.changes(log, cdc.position_at(log, CHANGES_SINCE)).drop(cdc.COMMIT_TS)


@register()
def cdc_net_changes(spark: SparkSession, d: str) -> DataFrame:
    log = src.changelog(spark, d)
    since, until = (cdc.position_at(log, ts) for ts in (CHANGES_SINCE, CHANGES_UNTIL))
    return cdc.net_changes(log, "pk", since, until)


@register()
def cdc_net_changes_from_base(spark: SparkSession, d: str) -> DataFrame:
    """The same net changes, told from the state at the first position."""
    log = src.changelog(spark, d)
    since, until = (cdc.position_at(log, ts) for ts in (CHANGES_SINCE, CHANGES_UNTIL))
    return cdc.net_changes(log, "pk", since, until, base=cdc.state_at(log, "pk", since))


@register()
def cdc_net_row_changes(spark: SparkSession, d: str) -> DataFrame:
    """Net change per equal (pk, value) row, with updates told apart into the old and the new row."""
    log = src.changelog(spark, d)
    return cdc.net_row_changes(cdc.split_updates(log, "pk"), cdc.position_at(log, CHANGES_SINCE))


@register()
def mv_logged_sums(spark: SparkSession, d: str) -> DataFrame:
    """Stored sums of a logged table up to a position, with the later updates and deletes merged in."""
    log = src.changelog(spark, d)
    since = cdc.position_at(log, CHANGES_SINCE)
    rows = cdc.split_updates(log, "pk").withColumn("bucket", F.col("pk") % 10)
    stored = partial_sums(rows.where(F.col(cdc.SEQ) <= since), "bucket", "val")
    delta = partial_sums(cdc.changes(rows, since), "bucket", "val")
    return read_sums(merge_sums(stored, delta, "bucket"), "bucket")


@register()
def cdc_apply_changes(spark: SparkSession, d: str) -> DataFrame:
    """The table at a position with all later changes applied."""
    log = src.changelog(spark, d)
    since = cdc.position_at(log, CHANGES_SINCE)
    return cdc.apply_changes(cdc.state_at(log, "pk", since), cdc.changes(log, since), "pk")


@register()
def cdc_pending_count(spark: SparkSession, d: str) -> DataFrame:
    log = src.changelog(spark, d)
    return cdc.pending_changes(log, cdc.position_at(log, CHANGES_SINCE))


@register()
def cdc_fact_load(spark: SparkSession, d: str) -> DataFrame:
    since = cdc.position_at(src.retail_order_log(spark, d, customer=False), FACTS_SINCE)
    return retail.load_fact_sales(cdc.changes(src.retail_order_log(spark, d), since))


@register()
def time_travel_as_of(spark: SparkSession, d: str) -> DataFrame:
    return cdc.as_of(src.changelog(spark, d), "pk", AS_OF_TS, AS_OF_OFFSET_S)


@register()
def reconcile_counts(spark: SparkSession, d: str) -> DataFrame:
    orders, log = src.retail_order_log(spark, d, customer=False), src.changelog(spark, d)
    return reconcile(
        [
            ("raw_orders", orders, retail.load_fact_sales(orders)),
            ("changelog", log, cdc.state_at(log, "pk")),
        ]
    )


@register()
def count_crop_data(spark: SparkSession, d: str) -> DataFrame:
    return row_count(src.crop_data(spark, d))
