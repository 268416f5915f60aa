"""Queries that go through files: CSV loads, streaming tasks and refreshed tables.

The input files are written by Spark from the test tables, and every job works in a new folder below
the cluster's shared one.
"""

from __future__ import annotations

import datetime
import decimal
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerline import schemas
from ledgerline.functions.masking import EMAIL_MASK, UNMASKED_ROLE
from ledgerline.functions.ordering import descending
from ledgerline.operators import changes as cdc
from ledgerline.operators.counts import content_differences, count_from_footers, reconcile
from ledgerline.plans import agriculture, customers, finance, retail
from ledgerline.plans.district_state import CROPS, RAINFALL, SIDES, SOIL, DistrictState, maintain_districts
from ledgerline.plans.registry import DELETE_BELOW, FACTS_SINCE, SALES_DAY, TEST_RULES, register
from ledgerline.plans.report import CachedReport, report_pages
from ledgerline.session import fresh_dir, shared_dir
from ledgerline.sources import sql_objects, tables
from ledgerline.sources import testdata as src
from ledgerline.sources.csv_files import CONTINUE, CsvFormat, Source, copy_into, list_files, load_csv
from ledgerline.sources.tables import create_layers, read_table, write_clustered
from ledgerline.streaming.changelog import ChangeLog
from ledgerline.streaming.ingest import csv_stream, ingest_stream
from ledgerline.streaming.refresh import refresh, refresh_sums
from ledgerline.streaming.runlog import RunLog
from ledgerline.streaming.sink import BatchSink
from ledgerline.streaming.tasks import load_task, summary_task

ORDERS = schemas.table(
    order_id=schemas.KEY,
    customer_id=schemas.KEY,
    amount=DecimalType(18, 2),
    order_date=schemas.DATE,
)
SCRATCH = "ledgerline_scratch"
FORMAT = CsvFormat(header=True, quote='"', null_tokens=("NULL", "null"))


def _drop_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", "true").option("quoteAll", "true").csv(path)


def _scratch_table(spark: SparkSession, name: str) -> str:
    """A new table name in a schema kept in the shared folder."""
    create_layers(spark, SCRATCH, base=shared_dir(spark))
    return f"{SCRATCH}.{name}_{uuid.uuid4().hex}"


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    # Recursive lookup also takes a table that is a single file; there is no partition folder to infer.
    reader = spark.readStream.schema(src.table(spark, d, name).schema)
    return reader.option("recursiveFileLookup", "true").parquet(f"{d}/{name}.parquet")


@register()
def csv_load_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as quoted CSV and loaded back with their declared types."""
    path = fresh_dir(spark, "csv-load")
    _drop_csv(src.crm_orders(spark, d), path)
    return load_csv(spark, Source(path, FORMAT), ORDERS).rows


@register()
def csv_load_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Good and bad rows per reason when the amounts of one order status are no numbers."""
    path = fresh_dir(spark, "csv-rejects")
    shipped = F.col("o_orderstatus") == "P"
    total = F.col("o_totalprice").cast(DecimalType(18, 2)).cast("string")
    _drop_csv(
        src.table(spark, d, "orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(shipped, "pending").otherwise(total).alias("amount"),
            F.to_date("o_orderdate").alias("order_date"),
        ),
        path,
    )
    loaded = load_csv(spark, Source(path, FORMAT), ORDERS, on_error=CONTINUE)
    good = loaded.rows.select(F.lit("loaded").alias("outcome"))
    bad = loaded.rejects.select(F.col("_reject_reason").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count("*").alias("row_count"))


@register()
def csv_load_aborted(spark: SparkSession, d: str) -> DataFrame:
    """A table after a good drop and one with a bad row, whose load is aborted and leaves the table as it was."""
    table, base = f"{_scratch_schema(spark)}.orders", fresh_dir(spark, "csv-abort")
    tables.create_table(spark, table, ORDERS)
    orders = src.crm_orders(spark, d)
    early = F.col("order_date") < F.lit(FACTS_SINCE).cast("date")
    _drop_csv(orders.where(early), f"{base}/good")
    late = cdc.keep_after_delete(orders, early)
    _drop_csv(late.withColumn("amount", F.when(F.col("order_id") % 2 == 0, F.col("amount").cast("string")).otherwise("pending")), f"{base}/bad")
    copy_into(spark, Source(f"{base}/good", FORMAT), ORDERS, table)
    try:
        copy_into(spark, Source(f"{base}/bad", FORMAT), ORDERS, table)
    except Exception:  # noqa: BLE001 - the abort is the point; what it leaves is checked
        return read_table(spark, table)
    raise AssertionError("a load with bad rows was not aborted")


@register()
def ingest_stream_orders(spark: SparkSession, d: str) -> DataFrame:
    """Two drops of CSV files, each followed by a run of the same ingest task."""
    base = fresh_dir(spark, "ingest")
    source = Source(f"{base}/drop", FORMAT)
    target = BatchSink(spark, f"{base}/orders", ORDERS)
    orders = src.crm_orders(spark, d)
    early = F.col("order_date") < F.lit(FACTS_SINCE).cast("date")
    for drop in (orders.where(early), cdc.keep_after_delete(orders, early)):
        _drop_csv(drop, source.path)
        ingest_stream(
            "ingest_orders", csv_stream(spark, source, ORDERS), target, f"{base}/checkpoint"
        ).run()
    return target.read()


@register()
def task_fact_load(spark: SparkSession, d: str) -> DataFrame:
    """Raw orders logged as changes, then loaded into the facts by a task following the log."""
    base = fresh_dir(spark, "fact-load")
    log = ChangeLog(spark, f"{base}/log", src.retail_orders(spark, d).schema)
    target = BatchSink(spark, f"{base}/facts", retail.load_fact_sales(log.read()).schema)
    task = None
    orders = src.retail_order_log(spark, d)
    early = F.col("order_date") < F.lit(FACTS_SINCE).cast("date")
    for commit in (orders.where(early), cdc.keep_after_delete(orders, early)):
        log.commit(commit)
        task = task or load_task(
            "load_facts",
            log.stream(),
            target,
            f"{base}/checkpoint",
            transform=retail.load_fact_sales,
        )
        task.run()
    return target.read()


@register()
def task_enrich_transactions(spark: SparkSession, d: str) -> DataFrame:
    """Transactions enriched as they stream in, with the merchants joined from their table."""
    base = fresh_dir(spark, "enrich")
    raw = src.with_merchant(
        src.transaction_lines(_stream(spark, d, "lineitem")), src.table(spark, d, "part")
    )
    curated = finance.enrich_transactions(raw, TEST_RULES)
    target = BatchSink(spark, f"{base}/transactions", curated.schema)
    load_task(
        "enrich", curated, target, f"{base}/checkpoint", transform=lambda rows: rows
    ).run()
    return target.read()


@register()
def refresh_sales_summary(spark: SparkSession, d: str) -> DataFrame:
    """The sales summary kept up to date from the stream of facts."""
    table = _scratch_table(spark, "sales_summary")
    facts = retail.build_fact_sales(src.retail_lines(_stream(spark, d, "lineitem")))
    refresh_sums(
        "sales_summary",
        facts,
        ["product_id"],
        [F.sum("sales_amount").alias("total_sales")],
        table,
        fresh_dir(spark, "refresh-checkpoint"),
    ).run()
    return read_table(spark, table)


@register()
def clustered_sales_on_date(spark: SparkSession, d: str) -> DataFrame:
    """One day of the facts, read from a copy clustered by date."""
    table = _scratch_table(spark, "fact_sales")
    write_clustered(retail.build_fact_sales(src.retail_orders(spark, d)), table, "order_date")
    return retail.sales_on(read_table(spark, table), SALES_DAY)


def _scratch_schema(spark: SparkSession) -> str:
    name = f"{SCRATCH}_{uuid.uuid4().hex}"
    create_layers(spark, name, base=shared_dir(spark))
    return name


@register()
def csv_null_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Amounts written as one of two NULL tokens, in padded fields, load as NULL."""
    path = fresh_dir(spark, "csv-nulls")
    key = F.col("order_id")
    amount = F.when(key % 6 == 0, "NULL").when(key % 3 == 0, "null").otherwise(F.col("amount").cast("string"))
    padded = [F.concat(F.lit("  "), c, F.lit(" ")) for c in (key.cast("string"), amount)]
    orders = src.crm_orders(spark, d).select(
        padded[0].alias("order_id"), "customer_id", padded[1].alias("amount"), "order_date"
    )
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    orders.write.option("header", "true").options(**spaces).csv(path)
    trimmed = CsvFormat(header=True, null_tokens=("NULL", "null"), trim=True)
    return load_csv(spark, Source(path, trimmed), ORDERS).rows


def _two_drops(spark: SparkSession, d: str) -> Source:
    path = fresh_dir(spark, "csv-named")
    orders, even = src.crm_orders(spark, d), F.col("order_id") % 2 == 0
    _drop_csv(orders.where(even), f"{path}/day.csv")
    _drop_csv(orders.where(~even), f"{path}/day.csv.old")
    return Source(path, FORMAT)


@register()
def csv_named_file(spark: SparkSession, d: str) -> DataFrame:
    """One of two drops, the name of which begins the other's."""
    return load_csv(spark, _two_drops(spark, d), ORDERS, file="day.csv").rows


@register()
def csv_listed_files(spark: SparkSession, d: str) -> DataFrame:
    """The drops whose name starts alike, as the listing of their files shows them."""
    listed = list_files(spark, _two_drops(spark, d), prefix="day")
    drop = F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("drop_name")
    return listed.groupBy(drop).agg((F.sum("length") > 0).alias("has_bytes"))


@register()
def table_created_like(spark: SparkSession, d: str) -> DataFrame:
    """A table like another one, filled from it, with a literal row inserted and rows deleted."""
    schema = _scratch_schema(spark)
    tables.create_table(spark, f"{schema}.raw", ORDERS)
    tables.create_like(spark, f"{schema}.staging", f"{schema}.raw")
    tables.append(src.crm_orders(spark, d).select(*ORDERS.fieldNames()), f"{schema}.raw")
    tables.append(read_table(spark, f"{schema}.raw"), f"{schema}.staging")
    row = (-1, 7, decimal.Decimal("250000.50"), datetime.date(2000, 1, 1))
    tables.insert_rows(spark, f"{schema}.staging", [row])
    tables.delete_where(spark, f"{schema}.staging", F.col("amount") < DELETE_BELOW)
    return read_table(spark, f"{schema}.staging")


@register()
def table_emptied(spark: SparkSession, d: str) -> DataFrame:
    """All rows deleted, with the deletes logged."""
    schema = _scratch_schema(spark)
    tables.materialize(src.crm_orders(spark, d), f"{schema}.orders")
    log = ChangeLog(spark, fresh_dir(spark, "delete-log"), read_table(spark, f"{schema}.orders").schema)
    tables.delete_where(spark, f"{schema}.orders", F.lit(True), log)
    none, n = F.lit(0).cast("long"), F.count("*")
    left = read_table(spark, f"{schema}.orders").agg(n.alias("rows_left"), none.alias("rows_logged"))
    deleted = log.read().where(F.col(cdc.OP) == cdc.DELETE)
    both = left.union(deleted.agg(none, n))
    return both.agg(F.sum("rows_left").alias("rows_left"), F.sum("rows_logged").alias("rows_logged"))


@register()
def cloned_tables(spark: SparkSession, d: str) -> DataFrame:
    """Row counts of a schema's tables and of their copies in a new schema."""
    schema, copy = _scratch_schema(spark), f"{SCRATCH}_{uuid.uuid4().hex}"
    tables.materialize(src.crop_data(spark, d), f"{schema}.crops")
    tables.materialize(src.soil_data(spark, d), f"{schema}.soil")
    names = tables.clone_tables(spark, schema, copy)
    return reconcile([(n, read_table(spark, f"{schema}.{n}"), read_table(spark, f"{copy}.{n}")) for n in names])


@register()
def reconcile_stored_copies(spark: SparkSession, d: str) -> DataFrame:
    """The raw tables of the agriculture project against their stored staging copies."""
    schema = _scratch_schema(spark)
    pairs = []
    for build in (src.crop_data, src.rainfall_data, src.soil_data, src.fertilizer_data, src.farmer_data):
        name = build.__name__
        tables.materialize(build(spark, d), f"{schema}.raw_{name}")
        tables.create_like(spark, f"{schema}.{name}", f"{schema}.raw_{name}")
        tables.append(read_table(spark, f"{schema}.raw_{name}"), f"{schema}.{name}")
        pairs.append((name, read_table(spark, f"{schema}.raw_{name}"), read_table(spark, f"{schema}.{name}")))
    return reconcile(pairs)


@register()
def reconcile_content(spark: SparkSession, d: str) -> DataFrame:
    """Orders against a stored copy with as many rows, of which some have another amount: the rows that differ."""
    table, orders = f"{_scratch_schema(spark)}.orders", src.crm_orders(spark, d)
    changed = F.when(F.col("order_id") % 997 == 0, 1).otherwise(0)
    tables.materialize(orders.withColumn("amount", (F.col("amount") + changed).cast(DecimalType(18, 2))), table)
    return content_differences(orders, read_table(spark, table), "order_id")


@register()
def count_rows_from_footers(spark: SparkSession, d: str) -> DataFrame:
    """Line items counted from the footers of their files."""
    return count_from_footers(spark, f"{d}/lineitem.parquet")


@register()
def masked_table_read(spark: SparkSession, d: str) -> DataFrame:
    """A table with a mask bound to a column, read without naming a role."""
    table = f"{_scratch_schema(spark)}.customers"
    tables.materialize(src.retail_customers(spark, d), table)
    tables.bind_masks(spark, table, {"email": EMAIL_MASK})
    return read_table(spark, table)


@register()
def masked_view_by_role(spark: SparkSession, d: str) -> DataFrame:
    """Customers read with SQL alone from a masked view, by a reader without and by one with the unmasked role."""
    schema, view = _scratch_schema(spark), f"customers_{uuid.uuid4().hex}"
    tables.materialize(src.retail_customers(spark, d), f"{schema}.customers")
    sql_objects.create_mask_functions(spark, schema)
    sql_objects.act_as(spark, None)
    sql_objects.create_masked_view(spark, view, f"{schema}.customers", schema, {"email": sql_objects.MASK_TEXT})
    hidden = spark.sql(f"SELECT 'none' AS reader, * FROM {view}")
    sql_objects.act_as(spark, UNMASKED_ROLE)
    clear = spark.sql(f"SELECT 'unmasked' AS reader, * FROM {view}")
    return hidden.unionByName(clear)


@register()
def mask_functions(spark: SparkSession, d: str) -> DataFrame:
    """Both mask functions called in SQL: what each customer spent as two roles see it."""
    schema = _scratch_schema(spark)
    sql_objects.create_mask_functions(spark, schema)
    name = f"orders_{uuid.uuid4().hex}"
    src.crm_orders(spark, d).createOrReplaceTempView(name)
    number, text = f"{schema}.{sql_objects.MASK_NUMBER}", f"{schema}.{sql_objects.MASK_TEXT}"
    by_role = [
        f"SELECT customer_id, {text}(CAST(customer_id AS STRING), '{role}') AS shown_id, '{role}' AS role, "
        f"SUM({number}(amount, '{role}')) AS total_spent FROM {name} GROUP BY customer_id"
        for role in (UNMASKED_ROLE, "ANALYST")
    ]
    return spark.sql(" UNION ALL ".join(by_role))


@register()
def task_history_function(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of a loading task as a table function with named arguments tells them, with the rows of each."""
    schema, base = _scratch_schema(spark), fresh_dir(spark, "history")
    sql_objects.create_history_function(spark, "task_history", f"{schema}.runs")
    orders = src.crm_orders(spark, d)
    log = ChangeLog(spark, f"{base}/log", orders.schema)
    target = BatchSink(spark, f"{base}/orders", orders.schema)
    early = F.col("order_date") < F.lit(FACTS_SINCE).cast("date")
    for commit in (orders.where(early), cdc.keep_after_delete(orders, early)):
        log.commit(commit, cdc.INSERT)
        task = load_task("loader", log.stream(), target, f"{base}/checkpoint")
        task.run()
        sql_objects.record_runs(spark, task.query, f"{schema}.runs")
    return sql_objects.history(spark, "task_history", "loader")


@register()
def task_run_history(spark: SparkSession, d: str) -> DataFrame:
    """States of a task's runs: one with new rows, and one on a commit without any, which is skipped."""
    base = fresh_dir(spark, "run-history")
    orders, runs = src.crm_orders(spark, d), RunLog(spark, f"{base}/runs")
    log = ChangeLog(spark, f"{base}/log", orders.schema)
    target = BatchSink(spark, f"{base}/orders", orders.schema)
    for commit in (orders, orders.limit(0)):
        log.commit(commit, cdc.INSERT)
        load_task("loader", log.stream(), target, f"{base}/checkpoint", skip_empty=True, run_log=runs).run()
    return runs.history("loader").groupBy("name", "state").agg(F.count("*").cast("int").alias("runs"))


@register()
def summary_appended_twice(spark: SparkSession, d: str) -> DataFrame:
    """A summary that a task appends in full at every run, summed by name."""
    base = fresh_dir(spark, "summary")
    orders = src.crm_orders(spark, d)
    summary = customers.customer_summary(src.crm_customers(spark, d), orders)
    log = ChangeLog(spark, f"{base}/log", orders.schema)
    target = BatchSink(spark, f"{base}/summary", summary.schema)
    early = F.col("order_date") < F.lit(FACTS_SINCE).cast("date")
    for commit in (orders.where(early), cdc.keep_after_delete(orders, early)):
        log.commit(commit, cdc.INSERT)
        summary_task("summary", log.stream(), lambda: summary, target.append, f"{base}/checkpoint").run()
    return customers.spend_by_name(target.read())


@register()
def pipeline_listing(spark: SparkSession, d: str) -> DataFrame:
    """Tables and views of a schema, without the session's temporary ones."""
    schema = _scratch_schema(spark)
    tables.materialize(src.crm_orders(spark, d), f"{schema}.orders")
    spark.sql(f"CREATE VIEW {schema}.orders_view AS SELECT * FROM {schema}.orders")
    return tables.list_objects(spark, [schema]).where(F.col("schema") == schema).select("name", "kind")


@register()
def report_frame(spark: SparkSession, d: str) -> DataFrame:
    """A cached report of every product brought to the client in pages, best first, and made a frame again."""
    lines = retail.build_fact_sales(src.retail_orders(spark, d, customer=False))
    report = CachedReport(lambda: retail.sales_summary(lines))
    target = BatchSink(spark, fresh_dir(spark, "report-frame"), report.get().schema)
    for number, page in enumerate(report_pages(report.get(), descending("total_sales"), "product_id")):
        target.append(spark.createDataFrame(page, target.schema).coalesce(1), f"page-{number}")
    report.clear()
    return target.read()


@register(avg_rainfall=6)
def agri_kpi_refreshed(spark: SparkSession, d: str) -> DataFrame:
    """The KPI table kept fresh over the stored district summary."""
    schema, base = _scratch_schema(spark), fresh_dir(spark, "kpi")
    crops = src.crop_data(spark, d)
    sides = [f(spark, d) for f in (src.rainfall_data, src.soil_data, src.fertilizer_data, src.farmer_data)]
    tables.materialize(agriculture.district_summary(crops, *sides), f"{schema}.district_summary")
    log = ChangeLog(spark, f"{base}/log", crops.schema)
    log.commit(crops, cdc.INSERT)

    def build() -> DataFrame:
        return agriculture.agri_kpi(read_table(spark, f"{schema}.district_summary"))

    refresh("agri_kpi", log.stream(), build, f"{schema}.agri_kpi", f"{base}/checkpoint").run()
    return read_table(spark, f"{schema}.agri_kpi")


def _district_batches(spark: SparkSession, d: str) -> list[dict[str, DataFrame]]:
    """All five tables of the agriculture project in three batches of inserts and deletes.

    The first has a third of the rows, and another third with wrong measures and farmers; the second puts those of
    crops, rainfall and soil right; the third does so for the others and adds the last third of all.
    """
    frames = dict(zip(SIDES, (f(spark, d) for f in (src.crop_data, src.rainfall_data, src.soil_data, src.fertilizer_data, src.farmer_data))))
    batches: list[dict[str, DataFrame]] = [{}, {}, {}]
    for side, rows in frames.items():
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
        measure = SIDES[side][0] or "farmer_id"
        insert, delete = F.lit(cdc.INSERT).alias(cdc.OP), F.lit(cdc.DELETE).alias(cdc.OP)
        of = lambda n, rows=rows, part=part: rows.where(part == n)
        wrong = of(1).withColumn(measure, (F.col(measure) + 1).cast(rows.schema[measure].dataType))
        batches[0][side] = of(0).unionByName(wrong).select("*", insert)
        mended = wrong.select("*", delete).unionByName(of(1).select("*", insert))
        last = of(2).select("*", insert)
        if side in (CROPS, RAINFALL, SOIL):
            batches[1][side], batches[2][side] = mended, last
        else:
            batches[2][side] = mended.unionByName(last)
    return batches


def _maintained_districts(spark: SparkSession, d: str) -> DistrictState:
    base, state = fresh_dir(spark, "districts"), DistrictState(spark, _scratch_schema(spark), count=4)
    state.create()
    batches = _district_batches(spark, d)
    logs = {side: ChangeLog(spark, f"{base}/{side}", rows.drop(cdc.OP).schema) for side, rows in batches[0].items()}
    for batch in batches:
        for side, rows in batch.items():
            logs[side].commit(rows)
        streams = {side: log.stream() for side, log in logs.items()}
        maintain_districts("districts", state, streams, f"{base}/checkpoint").run()
    return state


@register(avg_rainfall=6, avg_ph=6)
def district_summary_maintained(spark: SparkSession, d: str) -> DataFrame:
    """The district summary after three batches of changes to all five tables, each folded into stored states."""
    return _maintained_districts(spark, d).summary()


@register(avg_rainfall=6)
def agri_kpi_maintained(spark: SparkSession, d: str) -> DataFrame:
    """The KPI table after the same batches, worked out again for touched districts only."""
    return _maintained_districts(spark, d).kpi()


@register()
def mv_customer_stored(spark: SparkSession, d: str) -> DataFrame:
    """The customer view stored, and refreshed when orders come in."""
    table, base = f"{_scratch_schema(spark)}.mv_customer", fresh_dir(spark, "mv-customer")
    people, orders = src.crm_customers(spark, d), src.crm_orders(spark, d)
    log = ChangeLog(spark, f"{base}/log", orders.schema)

    def build() -> DataFrame:
        return customers.mv_customer(customers.customer_summary(people, log.read().drop(*cdc.META)))

    early = F.col("order_date") < F.lit(FACTS_SINCE).cast("date")
    for commit in (orders.where(early), cdc.keep_after_delete(orders, early)):
        log.commit(commit, cdc.INSERT)
        refresh("mv_customer", log.stream(), build, table, f"{base}/checkpoint").run()
    return read_table(spark, table)


@register()
def ingest_two_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    """Two locations loaded into one target by tasks of one name, each with a checkpoint of its own."""
    base = fresh_dir(spark, "ingest-two")
    target = BatchSink(spark, f"{base}/orders", ORDERS)
    orders = src.crm_orders(spark, d)
    early = F.col("order_date") < F.lit(FACTS_SINCE).cast("date")
    for n, drop in enumerate((orders.where(early), cdc.keep_after_delete(orders, early))):
        source = Source(f"{base}/drop-{n}", FORMAT)
        _drop_csv(drop, source.path)
        ingest_stream("ingest", csv_stream(spark, source, ORDERS), target, f"{base}/checkpoint-{n}").run()
    return target.read()
