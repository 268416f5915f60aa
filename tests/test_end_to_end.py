"""Each business area from CSV files to its report."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.masking import EMAIL_MASK
from ledgerline.operators.changes import as_of
from ledgerline.operators.counts import reconcile
from ledgerline.plans import agriculture, customers, finance, retail
from ledgerline.plans.report import to_report
from ledgerline.sources import tables
from ledgerline.sources.csv_files import CONTINUE, CsvFormat, Source, copy_into, load_csv
from ledgerline.streaming.changelog import ChangeLog
from ledgerline.streaming.ingest import csv_stream, ingest_stream
from ledgerline.streaming.refresh import refresh, refresh_sums
from ledgerline.streaming.runlog import RunLog
from ledgerline.streaming.sink import BatchSink
from ledgerline.streaming.tasks import load_task

AGRO_FILES = {
    "crop_data": (
        schemas.CROP_DATA,
        "crop_id,crop_name,state,district,year,production_tonnes,area_hectares\n"
        "1,RICE,MH,Latur,2025,100,10\n2,SOY,MH,LATUR,2025,50,5\nbad,SOY,MH,LATUR,2025,50,5\n"
        "3,RICE,MH,Pune,2024,70,7\n",
    ),
    "rainfall_data": (
        schemas.RAINFALL_DATA,
        "record_id,district,year,rainfall_mm\n1,latur,2025,10\n2,Latur,2025,20\n3,Pune,2025,99\n",
    ),
    "soil_data": (
        schemas.SOIL_DATA,
        "soil_id,district,soil_type,ph_level,nitrogen,phosphorus,potassium\n"
        "1,LATUR,black,6.5,1,1,1\n2,Pune,red,5,1,1,1\n",
    ),
    "fertilizer_data": (
        schemas.FERTILIZER_DATA,
        "fertilizer_id,district,fertilizer_type,quantity_used_kg\n1,Latur,urea,30\n2,Latur,dap,5\n",
    ),
    "farmer_data": (
        schemas.FARMER_DATA,
        "farmer_id,name,district,land_area_acres\n1,A,Latur,2\n2,B,LATUR,3\n",
    ),
}


def test_agriculture(spark, tmp_path, schema, rows):
    drop = tmp_path / "farm data"
    drop.mkdir()
    source = Source(str(drop), CsvFormat(header=True, quote='"'))
    runs = RunLog(spark, str(tmp_path / "runs"))
    logs, staging = {}, {}
    for name, (declared, _) in AGRO_FILES.items():
        logs[name] = ChangeLog(spark, str(tmp_path / "raw" / name), declared)
        staging[name] = BatchSink(
            spark, str(tmp_path / "staging" / name), schemas.frame_schema(declared)
        )

    def run_all():
        for name, (declared, _) in AGRO_FILES.items():
            ingest_stream(
                f"{name}_pipe",
                csv_stream(spark, source, declared, f"{name}.csv"),
                logs[name],
                str(tmp_path / "cp" / f"{name}_pipe"),
                rejects_path=str(tmp_path / "rejects" / name),
            ).run()
            load_task(
                f"{name}_task",
                logs[name].stream(),
                staging[name],
                str(tmp_path / "cp" / f"{name}_task"),
                run_log=runs,
            ).run()

    for name, (_, text) in AGRO_FILES.items():
        (drop / f"{name}.csv").write_text(text)
    run_all()
    assert spark.read.parquet(str(tmp_path / "rejects" / "crop_data")).count() == 1
    counts = reconcile([(n, logs[n].read(), staging[n].read()) for n in AGRO_FILES])
    assert {r["diff"] for r in counts.collect()} == {0}

    def summary():
        tables.materialize(
            agriculture.district_summary(*[s.read() for s in staging.values()]),
            f"{schema}.district_summary",
            replace=True,
        )
        return agriculture.agri_kpi(tables.read_table(spark, f"{schema}.district_summary"))

    def kpi_task():
        return refresh(
            "agri_kpi",
            logs["crop_data"].stream(),
            summary,
            f"{schema}.agri_kpi",
            str(tmp_path / "cp" / "agri_kpi"),
        )

    kpi_task().run()
    stored = tables.read_table(spark, f"{schema}.district_summary")
    got = {(r["district"], r["crop_name"]): tuple(r)[2:] for r in stored.collect()}
    # Latur: 2 rainfall records x 1 soil x 2 fertilizers x 2 farmers = 8 copies of each crop row;
    # pH 6.5 was stored as 7, since the declared number has no fraction.
    assert got[("Latur", "RICE")] == (Decimal(800), 15.0, 7.0, Decimal(35 * 4), 2)
    assert got[("LATUR", "SOY")] == (Decimal(400), 15.0, 7.0, Decimal(35 * 4), 2)
    assert got[("Pune", "RICE")] == (Decimal(70), None, 5.0, None, 0)
    kpis = tables.read_table(spark, f"{schema}.agri_kpi")
    assert rows(agriculture.agri_kpi_dashboard(kpis)) == [(1270.0, 15.0, 4, 3)]

    sample = (1001, "SOYABEAN", "MAHARASHTRA", "LATUR", 2025, Decimal(5000), Decimal(500))
    logs["crop_data"].commit(
        spark.createDataFrame([sample], schemas.CROP_DATA), "INSERT"
    )
    run_all()
    kpi_task().run()
    assert staging["crop_data"].read().where("crop_id = 1001").count() == 1
    kpis = tables.read_table(spark, f"{schema}.agri_kpi").where("district = 'LATUR'").first()
    assert kpis["total_production"] == Decimal(400 + 5000 * 8)
    states = [r["state"] for r in runs.history("crop_data_task").collect()]
    assert states == ["SUCCEEDED", "SUCCEEDED"]


def test_retail(spark, tmp_path, schema, rows):
    drop = tmp_path / "bucket"
    texts = {
        "customers": "customer_id,customer_name,email,city\nC1,\"Rao, A\",a@x.in,Pune\nC2,Bo,NULL,null\n",
        "products": "product_id,product_name,category,unit_price\nP1,pen,office,10\nP2,ink,office,5\n",
        "stores": "store_id,store_name,location\nS1,north,Pune\n",
        "inventory": "inventory_id,product_id,store_id,stock_qty\nI1,P1,S1,9\n",
        "orders": "order_id,customer_id,product_id,store_id,qty,price,order_date\n"
        "1,C1,P1,S1,2,10,2026-01-01\n2,C2,P2,S1,1,5,2026-01-02\n3,C9,P1,S1,1,10,2026-01-01\n",
    }
    declared = {
        "customers": schemas.RAW_CUSTOMERS,
        "products": schemas.RAW_PRODUCT,
        "stores": schemas.RAW_STORES,
        "inventory": schemas.RAW_INVENTORY,
        "orders": schemas.RAW_ORDERS,
    }
    drop.mkdir()
    source = Source(str(drop), CsvFormat(header=True, quote='"', null_tokens=("NULL", "null")))
    for name, text in texts.items():
        (drop / f"{name}.csv").write_text(text)
        tables.create_table(spark, f"{schema}.raw_{name}", declared[name])
        copy_into(spark, source, declared[name], f"{schema}.raw_{name}", prefix=name)
    raw = {n: tables.read_table(spark, f"{schema}.raw_{n}") for n in texts}
    for name in ("customers", "products", "stores"):
        tables.materialize(retail.build_dim(raw[name]), f"{schema}.dim_{name}")
    facts = retail.build_fact_sales(raw["orders"])
    tables.write_clustered(facts, f"{schema}.fact_sales", "order_date", partitions=2)

    facts = tables.read_table(spark, f"{schema}.fact_sales")
    dims = [
        tables.read_table(spark, f"{schema}.dim_{n}", masks, "ANALYST")
        for n, masks in (("customers", {"email": EMAIL_MASK}), ("products", None), ("stores", None))
    ]
    assert rows(dims[0]) == [("C1", "Rao, A", "*****", "Pune"), ("C2", "Bo", "*****", None)]
    assert rows(retail.product_sales(facts, dims[1])) == [("ink", 5), ("pen", 20)]
    assert rows(retail.customer_orders(facts, *dims)) == [("Bo", 1), ("Rao, A", 1)]
    assert retail.total_sales(facts).first()[0] == 25
    assert [r[0] for r in retail.recent_sales(facts, *dims).collect()] == ["Bo", "Rao, A"]
    assert {r["order_id"] for r in retail.sales_on(facts, "2026-01-01").collect()} == {1, 3}

    # The task loads later orders, the summary follows, and the earlier state can still be read.
    log = ChangeLog(spark, str(tmp_path / "order_log"), schemas.RAW_ORDERS)
    loaded = BatchSink(spark, str(tmp_path / "facts"), facts.schema)
    noon = dt.datetime(2026, 1, 3, 12)
    for minutes, (order, op) in enumerate(
        [((4, "C1", "P1", "S1", 1, 7, None), "INSERT"), ((4, "C1", "P1", "S1", 1, 7, None), "DELETE")]
    ):
        frame = spark.createDataFrame([order], schemas.frame_schema(schemas.RAW_ORDERS))
        log.commit(frame, op, commit_ts=noon + dt.timedelta(minutes=10 * minutes))
        load_task(
            "load_fact",
            log.stream(),
            loaded,
            str(tmp_path / "cp1"),
            transform=retail.load_fact_sales,
        ).run()
        refresh_sums(
            "dt_sales_summary",
            retail.load_fact_sales(log.stream()),
            ["product_id"],
            [F.sum("sales_amount").alias("total_sales")],
            f"{schema}.dt_sales_summary",
            str(tmp_path / "cp2"),
        ).run()
    assert rows(loaded.read().select("order_id", "sales_amount")) == [(4, 7)]
    assert rows(tables.read_table(spark, f"{schema}.dt_sales_summary")) == [("P1", 7)]
    now = noon + dt.timedelta(minutes=12)
    assert as_of(log.read(), "order_id", now).count() == 0
    assert as_of(log.read(), "order_id", now, offset_s=300).count() == 1


def test_customer_orders(spark, tmp_path, schema):
    for name, text in (
        ("customers", "1,Asha,Pune\n2,Ravi,Latur\n"),
        ("orders", "10,1,100,2025-01-01\n11,1,50,2025-01-02\n12,2,70,2025-01-03\n"),
    ):
        (tmp_path / f"{name}.csv").write_text(text)
    source = Source(str(tmp_path), CsvFormat())
    people = load_csv(spark, source, schemas.CUSTOMERS, "customers.csv").rows
    orders = load_csv(spark, source, schemas.ORDERS, "orders.csv").rows
    tables.materialize(customers.customer_summary(people, orders), f"{schema}.customer_summary")
    summary = tables.read_table(spark, f"{schema}.customer_summary")
    report = to_report(customers.spend_by_name(summary))
    assert report.values.tolist() == [["Asha", 150], ["Ravi", 70]]
    masked = customers.customer_summary(people, orders, role="DB_ANALYST")
    assert to_report(customers.spend_by_name(masked))["total_spent"].tolist() == [0, 0]


def test_finance(spark, tmp_path, rows):
    drop = tmp_path / "drop"
    drop.mkdir()
    source = Source(str(drop), CsvFormat(header=True, trim=True))
    log = ChangeLog(spark, str(tmp_path / "raw"), schemas.TRANSACTIONS_RAW)
    curated = BatchSink(
        spark,
        str(tmp_path / "curated"),
        finance.enrich_transactions(log.read()).drop("op", "seq", "commit_ts").schema,
    )
    header = "transaction_id,txn_date,description,amount,type,category\n"
    drops = {
        "jan.csv": "1, 2025-01-05 , Swiggy lunch , -250.00,DEBIT,Misc\n2,2025-01-31,Salary,1000.00,CREDIT,Pay\n",
        "feb.csv": "3,2025-02-01,Netflix,-199.50,DEBIT,Misc\nx,2025-02-01,broken,1,DEBIT,Misc\n",
    }
    for name, text in drops.items():
        (drop / name).write_text(header + text)
        ingest_stream(
            "transaction_pipe",
            csv_stream(spark, source, schemas.TRANSACTIONS_RAW),
            log,
            str(tmp_path / "cp1"),
            on_error=CONTINUE,
        ).run()
        load_task(
            "process_transactions",
            log.stream(),
            curated,
            str(tmp_path / "cp2"),
            transform=finance.enrich_transactions,
        ).run()
    transactions = curated.read()
    assert rows(finance.category_expense(transactions)) == [
        ("Entertainment", Decimal("199.50")),
        ("Food", Decimal("250.00")),
    ]
    assert [tuple(r) for r in finance.income_expense(transactions).collect()] == [
        ("Feb", Decimal("0.00"), Decimal("199.50")),
        ("Jan", Decimal("1000.00"), Decimal("250.00")),
    ]
    health = finance.financial_health(transactions).first()
    assert tuple(health) == (55.05, "Excellent")
