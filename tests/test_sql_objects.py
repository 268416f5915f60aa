"""Mask functions, masked views and the history function, as SQL sees them."""

import decimal

import pytest

from ledgerline.functions.masking import UNMASKED_ROLE
from ledgerline.sources import sql_objects, tables


@pytest.fixture
def people(spark, schema):
    rows = spark.createDataFrame([(1, "a@x", 5), (2, None, None)], "id long, email string, amount int")
    rows = rows.selectExpr("id", "email", "CAST(amount AS DECIMAL(18, 2)) AS amount")
    tables.materialize(rows, f"{schema}.people")
    sql_objects.create_mask_functions(spark, schema)
    return f"{schema}.people"


def test_plain_reads_of_a_masked_view_see_masks(spark, schema, people):
    sql_objects.act_as(spark, None)
    masked = {"email": sql_objects.MASK_TEXT, "amount": sql_objects.MASK_NUMBER}
    sql_objects.create_masked_view(spark, "people_shown", people, schema, masked)
    assert spark.table("people_shown").schema == spark.table(people).schema
    zero = decimal.Decimal("0.00")
    hidden = [(1, "*****", zero), (2, "*****", zero)]
    assert sorted(tuple(r) for r in spark.table("people_shown").collect()) == hidden
    for role, clear in ((UNMASKED_ROLE, True), ("ANALYST", False), ("x' OR '1' = '1", False)):
        sql_objects.act_as(spark, role)
        rows = sorted(tuple(r) for r in spark.sql("SELECT * FROM people_shown").collect())
        assert rows == ([(1, "a@x", decimal.Decimal("5.00")), (2, None, None)] if clear else hidden)
    spark.sql(f"SET VAR {sql_objects.ROLE} = '{UNMASKED_ROLE}'")
    assert spark.sql("SELECT SUM(amount) AS s FROM people_shown").first().s == 5


def test_masks_must_fit_their_columns(spark, schema, people):
    with pytest.raises(ValueError, match="not in the table"):
        sql_objects.create_masked_view(spark, "v", people, schema, {"nope": sql_objects.MASK_TEXT})
    with pytest.raises(ValueError, match="does not fit"):
        sql_objects.create_masked_view(spark, "v", people, schema, {"email": sql_objects.MASK_NUMBER})


def test_history_by_named_arguments(spark, schema):
    sql_objects.create_history_function(spark, "task_history", f"{schema}.runs")
    rows = [("a", 0, 5), ("a", 1, 6), ("b", 0, 7), ("it's", 3, 1)]
    spark.createDataFrame(rows, sql_objects.RUNS).write.insertInto(f"{schema}.runs")
    named = lambda *args: sorted(tuple(r) for r in sql_objects.history(spark, "task_history", *args).collect())
    assert named("a") == [("a", 0, 5), ("a", 1, 6)]
    assert named("a", 1) == [("a", 1, 6)] and named("it's") == [("it's", 3, 1)] and named("c") == []
    called = spark.sql("SELECT run FROM task_history(since_run => 1, task_name => 'a')")
    assert [r.run for r in called.collect()] == [1]
