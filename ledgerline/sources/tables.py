"""Catalog tables in layers: create, fill, delete from, copy, cluster and list them."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.masking import MaskPolicy, mask
from ledgerline.operators.changes import DELETE, INSERT, keep_after_delete
from ledgerline.schemas import frame_schema
from ledgerline.sources import buckets
from ledgerline.streaming.changelog import ChangeLog

_VERSION = "__at-"
#: Start of the table properties that hold masks, and the role of a reader without one.
_MASK = "mask."
NO_ROLE = ""


def create_layers(spark: SparkSession, *names: str, base: str | None = None) -> None:
    """Schemas such as raw, staging, curated, analytics and mart; below ``base`` when given."""
    for name in names:
        location = "" if base is None else f" LOCATION '{base.rstrip('/')}/{name}'"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{location}")


def stored_rows(spark: SparkSession, name: str) -> DataFrame:
    """A table's present rows as they are stored, for the jobs that maintain it.

    A session remembers where a table's files are; another one, such as that of a streaming task, may
    have pointed the table at newer ones, so the memory is refreshed first.
    """
    spark.catalog.refreshTable(name)
    return spark.table(name).drop(buckets.BUCKET)


def bind_masks(spark: SparkSession, name: str, policies: dict[str, MaskPolicy]) -> None:
    """Binds masks to columns of a table, which keeps them; every later :func:`read_table` applies them."""
    unknown = set(policies) - set(spark.table(name).columns)
    if unknown:
        raise ValueError(f"masked columns not in the table: {sorted(unknown)}")
    bound = ", ".join(
        "'{}{}' = '{}'".format(_MASK, column, json.dumps([p.otherwise, p.role]).replace("\\", "\\\\").replace("'", "\\'"))
        for column, p in policies.items()
    )
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({bound})")


def bound_masks(spark: SparkSession, name: str) -> dict[str, MaskPolicy]:
    """The masks bound to a table's columns."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key").startswith(_MASK)).collect()
    return {r["key"].removeprefix(_MASK): MaskPolicy(*json.loads(r["value"])) for r in rows}


def read_table(
    spark: SparkSession,
    name: str,
    policies: dict[str, MaskPolicy] | None = None,
    role: str | None = None,
) -> DataFrame:
    """A table's present rows, as ``role`` sees them: masks bound to its columns always apply, and further
    ``policies`` may be given. Who names no role sees masked values."""
    df = stored_rows(spark, name)
    masks = {**bound_masks(spark, name), **(policies or {})}
    if not masks:
        return df
    if role is None and policies:
        raise ValueError(f"{name} has masked columns, so a role is needed to read it")
    return mask(df, masks, role or NO_ROLE)


def create_table(
    spark: SparkSession, name: str, schema: StructType, replace: bool = False
) -> None:
    """An empty table with a declared schema."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{_location(spark, name)}")


def create_like(spark: SparkSession, name: str, source: str, replace: bool = False) -> None:
    """An empty table with the columns of another one."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} LIKE {source} USING parquet{_location(spark, name)}")


def create_in_buckets(
    spark: SparkSession, name: str, schema: StructType, keys: Sequence[str], count: int = buckets.BUCKETS
) -> None:
    """An empty table of which later folds by ``keys`` rewrite only the buckets they touch."""
    buckets.create_bucketed(spark, name, schema, keys, _new_path(spark, name), count)


def materialize_in_buckets(df: DataFrame, name: str, keys: Sequence[str], count: int = buckets.BUCKETS) -> None:
    """Stores a query's result as a new bucketed table."""
    create_in_buckets(df.sparkSession, name, df.schema, keys, count)
    fold_table(df.sparkSession, name, None, lambda _: df, uuid.uuid4().hex)


def fold_table(
    spark: SparkSession, name: str, changed: DataFrame | None, step: Callable[[DataFrame], DataFrame], label: str
) -> list[int]:
    """Replaces the rows of a bucketed table that share a bucket with a key of ``changed`` by ``step(rows)``.

    Without ``changed`` all buckets are replaced. Gives the buckets; repeating a label changes nothing.
    """
    how = buckets.layout(spark, name)
    if how is None:
        raise ValueError(f"{name} is not bucketed")

    def touched() -> Sequence[int]:
        return range(how.count) if changed is None else buckets.touched_buckets(changed, how)

    return buckets.fold_buckets(spark, name, touched, step, label)


def materialize(
    df: DataFrame, name: str, replace: bool = False, version: str | None = None
) -> None:
    """Stores a query's result as a table; replacing it may read the table's present rows.

    ``version`` labels the stored state; :func:`stored_version` tells it again.
    """
    if replace and df.sparkSession.catalog.tableExists(name):
        replace_contents(df, name, version)
        return
    path = _new_path(df.sparkSession, name, version)
    df.write.option("path", path).saveAsTable(name)


def append(df: DataFrame, name: str) -> None:
    """Inserts rows; columns are matched by position, as in ``INSERT INTO ... SELECT``."""
    df.write.insertInto(name)


def insert_rows(
    spark: SparkSession,
    name: str,
    rows: Iterable[Sequence[Any]],
    log: ChangeLog | None = None,
) -> None:
    """Inserts literal rows, and logs them when the table's changes are tracked."""
    df = spark.createDataFrame(list(rows), frame_schema(spark.table(name).schema))
    append(df, name)
    if log is not None:
        log.commit(df, INSERT)


def delete_where(
    spark: SparkSession, name: str, condition: Column, log: ChangeLog | None = None
) -> None:
    """Deletes the rows for which ``condition`` is true; with ``F.lit(True)``, all of them.

    Of a bucketed table only the buckets that hold such rows are rewritten.
    """
    rows = stored_rows(spark, name)
    if buckets.layout(spark, name) is not None:
        label = f"delete-{uuid.uuid4().hex}"
        if log is not None:
            log.commit(rows.where(condition), DELETE, writer=label)
        fold_table(spark, name, rows.where(condition), lambda kept: keep_after_delete(kept, condition), label)
        return
    path = _write_version(keep_after_delete(rows, condition), name)
    if log is not None:
        log.commit(rows.where(condition), DELETE)
    _switch(spark, name, path)


def replace_contents(df: DataFrame, name: str, version: str | None = None) -> None:
    """Replaces all rows of a table by ``df``, which may read the table itself.

    The rows are written to a new folder and the table is pointed at it afterwards, so a failed write
    changes nothing and running readers keep the files they started with. The schema of the table
    stays; columns are matched by name.
    """
    spark = df.sparkSession
    schema = spark.table(name).schema
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    _switch(spark, name, _write_version(typed, name, version))


def _table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {name}")
    return described.where("col_name = 'Location'").first()["data_type"]


def stored_version(spark: SparkSession, name: str) -> str | None:
    """The label of the state a table holds; None without a table or label."""
    if not spark.catalog.tableExists(name):
        return None
    bucketed = buckets.layout(spark, name)
    if bucketed is not None:
        return bucketed.label
    found = re.search(rf"{_VERSION}([^/]*)/?$", _table_location(spark, name))
    return found.group(1) if found else None


def drop_old_versions(spark: SparkSession, name: str, older_than: dt.timedelta) -> int:
    """Removes replaced folders of a table that are older than ``older_than``; gives their number.

    Replacing a table leaves its former folder to running readers. Run this from time to time with an
    age that no reader exceeds; the folder the table points at stays whatever its age.
    """
    present = _table_location(spark, name).rstrip("/").rsplit("/", 1)[1]
    base = _new_path(spark, name).rsplit("__", 1)[0]
    own = re.compile(rf"{re.escape(base.rsplit('/', 1)[1])}__[0-9a-f]{{32}}({_VERSION}.*)?")
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{base}__*")
    fs = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    before = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
    removed = 0
    for status in fs.globStatus(glob) or []:
        folder = status.getPath()
        version = own.fullmatch(folder.getName())
        if version and folder.getName() != present and status.getModificationTime() < before:
            removed += fs.delete(folder, True)
    return removed


def clone_tables(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copies every table of a schema into a new one; returns their names. The copies are full."""
    spark.sql(f"CREATE SCHEMA {target}")
    names = sorted(t.name for t in spark.catalog.listTables(source) if not t.isTemporary)
    for name in names:
        materialize(spark.table(f"{source}.{name}"), f"{target}.{name}")
    return names


def write_clustered(
    df: DataFrame, name: str, column: str, partitions: int | None = None
) -> None:
    """Stores rows so that each file holds a narrow range of ``column``.

    A filter on the column then skips whole files by their min/max statistics. Rows are ranged by
    (column, row hash), so the rows of one frequent value spread over several files and tasks.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    count = [] if partitions is None else [partitions]
    clustered = df.repartitionByRange(*count, F.col(column), spread).sortWithinPartitions(column)
    path = _new_path(df.sparkSession, name)
    clustered.write.option("path", path).saveAsTable(name)


def list_objects(spark: SparkSession, schemas: Sequence[str]) -> DataFrame:
    """Tables and views of the given schemas and the running streaming queries."""
    found = [
        ("" if t.isTemporary else schema, t.name, "VIEW" if t.tableType in ("VIEW", "TEMPORARY") else "TABLE", "")
        for schema in schemas
        for t in spark.catalog.listTables(schema)
    ]
    found += [("", q.name or str(q.id), "TASK", q.status["message"]) for q in spark.streams.active]
    return spark.createDataFrame(found, "schema string, name string, kind string, status string")


def _location(spark: SparkSession, name: str) -> str:
    return f" LOCATION '{_new_path(spark, name)}'"


def _new_path(spark: SparkSession, name: str, version: str | None = None) -> str:
    """A folder for a new version of a table's rows, beside its schema's other tables."""
    *schema, table = name.split(".")
    database = schema[-1] if schema else spark.catalog.currentDatabase()
    base = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    label = "" if version is None else f"{_VERSION}{version}"
    return f"{base}/{re.sub(r'[^A-Za-z0-9_]', '_', table)}__{uuid.uuid4().hex}{label}"


def _write_version(df: DataFrame, name: str, version: str | None = None) -> str:
    path = _new_path(df.sparkSession, name, version)
    df.write.parquet(path)
    return path


def _switch(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
