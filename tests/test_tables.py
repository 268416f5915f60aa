import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.masking import EMAIL_MASK
from ledgerline.operators.changes import changes, rows_after
from ledgerline.schemas import table
from ledgerline.sources import tables
from ledgerline.streaming.changelog import ChangeLog

SCHEMA = table(id=schemas.KEY, name=schemas.SHORT_TEXT, amount=schemas.MONEY)
DECLARED = {
    name: value for name, value in vars(schemas).items() if isinstance(value, schemas.StructType)
}


@pytest.mark.parametrize("name", sorted(DECLARED))
def test_declared_schemas_make_empty_tables(spark, schema, name):
    tables.create_table(spark, f"{schema}.{name}", DECLARED[name])
    df = tables.read_table(spark, f"{schema}.{name}")
    assert df.schema.fieldNames() == DECLARED[name].fieldNames()
    assert df.count() == 0


def test_create_like_is_empty(spark, schema):
    tables.create_table(spark, f"{schema}.raw", SCHEMA)
    tables.insert_rows(spark, f"{schema}.raw", [(1, "a", None)])
    tables.create_like(spark, f"{schema}.staging", f"{schema}.raw")
    tables.create_like(spark, f"{schema}.staging", f"{schema}.raw", replace=True)
    staging = tables.read_table(spark, f"{schema}.staging")
    assert staging.schema == tables.read_table(spark, f"{schema}.raw").schema
    assert staging.count() == 0


def test_append_matches_by_position(spark, schema, rows):
    tables.create_table(spark, f"{schema}.t", table(a=schemas.KEY, b=schemas.KEY))
    tables.append(spark.range(1).select(F.lit(1).alias("b"), F.lit(2).alias("a")), f"{schema}.t")
    assert rows(tables.read_table(spark, f"{schema}.t")) == [(1, 2)]


def test_delete_keeps_rows_where_the_condition_is_unknown(spark, schema, rows):
    name = f"{schema}.t"
    tables.create_table(spark, name, table(id=schemas.KEY, v=schemas.KEY))
    tables.insert_rows(spark, name, [(1, 10), (2, None), (3, 30)])
    tables.delete_where(spark, name, F.col("v") < 20)
    assert rows(spark.table(name)) == [(2, None), (3, 30)]
    tables.insert_rows(spark, name, [(4, 40)])
    assert spark.table(name).count() == 3
    tables.delete_where(spark, name, F.lit(True))
    assert spark.table(name).count() == 0


def test_replace_may_read_the_table_it_replaces(spark, schema, rows):
    name = f"{schema}.t"
    tables.materialize(spark.range(3), name)
    tables.materialize(spark.table(name).where("id > 0"), name, replace=True)
    assert rows(spark.table(name)) == [(1,), (2,)]
    with pytest.raises(Exception, match="already exists"):
        tables.materialize(spark.range(1), name)


def test_failed_replace_changes_nothing(spark, schema):
    name = f"{schema}.t"
    tables.materialize(spark.range(3), name)
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        tables.materialize(broken, name, replace=True)
    assert spark.table(name).count() == 3


def test_insert_and_delete_are_logged(spark, schema, tmp_path, rows):
    name = f"{schema}.crop_data"
    tables.create_table(spark, name, schemas.CROP_DATA)
    log = ChangeLog(spark, str(tmp_path / "log"), schemas.CROP_DATA)
    sample = (1001, "SOYABEAN", "MAHARASHTRA", "LATUR", 2025, Decimal(5000), Decimal(500))
    tables.insert_rows(spark, name, [sample], log)
    assert log.position() == 0
    assert [r["op"] for r in changes(log.read(), -1).collect()] == ["INSERT"]
    tables.delete_where(spark, name, F.col("crop_id") == 1001, log)
    assert spark.table(name).count() == 0
    assert [r["op"] for r in changes(log.read(), 0).collect()] == ["DELETE"]
    assert rows_after(log.read()).count() == 0


def test_clone_is_independent(spark, schema):
    target = f"{schema}_dev"
    tables.materialize(spark.range(2), f"{schema}.a")
    tables.materialize(spark.range(3), f"{schema}.b")
    assert tables.clone_tables(spark, schema, target) == ["a", "b"]
    tables.delete_where(spark, f"{schema}.a", F.lit(True))
    assert spark.table(f"{target}.a").count() == 2
    assert spark.table(f"{target}.b").count() == 3
    spark.sql(f"DROP SCHEMA {target} CASCADE")


def test_clustered_files_hold_narrow_ranges_also_for_a_hot_value(spark, schema):
    # A third of all rows share one date; the rest spread over 100 days.
    days = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).cast("int")
    facts = spark.range(30000).select("id", F.date_add(F.lit(dt.date(2026, 1, 1)), days).alias("d"))
    tables.write_clustered(facts, f"{schema}.f", "d", partitions=12)
    stored = spark.table(f"{schema}.f").withColumn("file", F.col("_metadata.file_path"))
    per_file = stored.groupBy("file").agg(F.count("*").alias("n"), F.min("d"), F.max("d")).collect()
    assert sum(r["n"] for r in per_file) == 30000
    assert max(r["n"] for r in per_file) < 30000 / 6
    probe = dt.date(2026, 3, 1)
    assert sum(r[2] <= probe <= r[3] for r in per_file) <= 2


def test_masked_read_needs_a_role(spark, schema, rows):
    name = f"{schema}.c"
    tables.materialize(spark.sql("select 1 id, 'a@b.c' email"), name)
    policies = {"email": EMAIL_MASK}
    with pytest.raises(ValueError):
        tables.read_table(spark, name, policies)
    assert rows(tables.read_table(spark, name, policies, "ANALYST")) == [(1, "*****")]
    assert rows(tables.read_table(spark, name, policies, "ACCOUNTADMIN")) == [(1, "a@b.c")]


def test_list_objects(spark, schema):
    tables.materialize(spark.range(1), f"{schema}.t")
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT 1 AS one")
    kinds = {(r["name"], r["kind"]) for r in tables.list_objects(spark, [schema]).collect()}
    assert {("t", "TABLE"), ("v", "VIEW")} <= kinds
