"""SQL objects that users call by name: mask functions, masked views and the history of tasks.

A masked view shows a table's columns through the mask functions, by the role that the session names in a variable.
Keep the base table in a schema that readers have no access to, and give them the view: plain reads, ``spark.table`` and
SQL, then see masked values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DecimalType, NumericType

from ledgerline.functions.masking import AMOUNT_MASK, EMAIL_MASK, MaskPolicy

#: The session variable that holds the reader's role; no role until it is set.
ROLE = "reader_role"
MASK_NUMBER, MASK_TEXT = "mask_number", "mask_text"
RUNS = "task STRING, run BIGINT, row_count BIGINT"


def _literal(value: object) -> str:
    return "'{}'".format(str(value).replace("\\", "\\\\").replace("'", "\\'"))


def create_mask_functions(spark: SparkSession, schema: str, amount: MaskPolicy = AMOUNT_MASK, text: MaskPolicy = EMAIL_MASK) -> None:
    """``mask_number(value, role)`` and ``mask_text(value, role)`` in a schema: the value for one role, a constant for others."""
    for name, kind, policy in ((MASK_NUMBER, "DECIMAL(38, 6)", amount), (MASK_TEXT, "STRING", text)):
        spark.sql(
            f"CREATE OR REPLACE FUNCTION {schema}.{name}(value {kind}, role STRING) RETURNS {kind} "
            f"RETURN CASE WHEN role = {_literal(policy.role)} THEN value ELSE CAST({_literal(policy.otherwise)} AS {kind}) END"
        )


def act_as(spark: SparkSession, role: str | None) -> None:
    """Sets the role by which masked views of this session show their columns; ``None`` is no role."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING DEFAULT {_literal(role or '')}")


def create_masked_view(spark: SparkSession, view: str, table: str, functions_in: str, masked: Mapping[str, str]) -> None:
    """A view of this session over ``table``; ``masked`` names the mask function of each column that has one.

    A role that is set later, by :func:`act_as` or in SQL, holds for every later read.
    """
    rows = spark.table(table)
    unknown = set(masked) - set(rows.columns)
    if unknown:
        raise ValueError(f"masked columns not in the table: {sorted(unknown)}")
    try:
        spark.sql(f"SELECT {ROLE}").schema
    except AnalysisException:  # no role was named in this session
        act_as(spark, None)

    def shown(field) -> str:
        name = f"`{field.name}`"
        if field.name not in masked:
            return name
        kind = field.dataType
        if isinstance(kind, DecimalType) and kind.scale > 6 or not isinstance(kind, NumericType) and masked[field.name] == MASK_NUMBER:
            raise ValueError(f"{field.name}: {kind.simpleString()} does not fit {masked[field.name]}")
        return f"CAST({functions_in}.{masked[field.name]}({name}, {ROLE}) AS {kind.simpleString()}) AS {name}"

    columns = ", ".join(map(shown, rows.schema))
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {columns} FROM {table}")


def create_history_function(spark: SparkSession, function: str, table: str) -> None:
    """``function(task_name => ..., since_run => ...)`` as a table of runs, over a table that :func:`record_runs` fills.

    It is a function of the session, as Spark calls table functions by a bare name only.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({RUNS}) USING parquet")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(task_name STRING, since_run BIGINT DEFAULT 0) RETURNS TABLE ({RUNS}) "
        f"RETURN SELECT task, run, row_count FROM {table} WHERE task = task_name AND run >= since_run"
    )


def record_runs(spark: SparkSession, query: StreamingQuery, table: str) -> None:
    """Appends the runs that a task's query reports of itself, each with the rows it took in.

    Spark keeps the last hundred of a query; they are its own numbers, so they follow from the input.
    """
    runs = [(query.name, p["batchId"], p["numInputRows"]) for p in query.recentProgress if p["numInputRows"]]
    spark.createDataFrame(runs, RUNS).coalesce(1).write.insertInto(table)


def history(spark: SparkSession, function: str, task: str, since_run: int = 0) -> DataFrame:
    """The runs of a task, by the SQL function."""
    return spark.sql(f"SELECT * FROM {function}(task_name => {_literal(task)}, since_run => {int(since_run)})")
