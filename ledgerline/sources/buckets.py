"""Catalog tables in buckets by a hash of their key, of which a change rewrites only those it touches.

A bucketed table is partitioned by ``_bucket``, the hash of its key columns modulo a number that is fixed when
the table is made; its properties keep both. A fold reads the touched buckets, writes their new rows aside
under its label, and then puts these in place of the old ones with a dynamic partition overwrite; buckets left
without rows are dropped. A fold that is repeated under its label takes the rows it wrote aside, so it
gives the same table wherever it was interrupted. One writer at a time; a reader beside it may see some buckets
before and some after the fold.

Choose the number of buckets so that one holds some hundred MiB: a fold costs the touched buckets, and a table is
listed by them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"
BUCKETS = 32
_COUNT, _KEYS, _LABEL, _ASIDE = "buckets.count", "buckets.keys", "buckets.label", "buckets.aside"


class Layout(NamedTuple):
    """How a table is bucketed."""

    count: int
    keys: tuple[str, ...]
    schema: StructType
    aside: str
    label: str | None

    def bucket(self) -> Column:
        """The bucket of a row with the key columns; they are hashed in the types the table has."""
        typed = [F.col(k).cast(self.schema[k].dataType) for k in self.keys]
        return F.pmod(F.xxhash64(*typed), F.lit(self.count)).cast("int")


def create_bucketed(
    spark: SparkSession, name: str, schema: StructType, keys: Sequence[str], path: str, buckets: int = BUCKETS
) -> None:
    """An empty table at ``path`` in ``buckets`` parts by a hash of ``keys``."""
    missing = [k for k in keys if k not in schema.fieldNames()]
    if missing or not keys:
        raise ValueError(f"keys that are no columns: {missing}" if missing else "a bucketed table needs a key")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    path = path.rstrip("/")
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {BUCKET} int) USING parquet "
        # An insert into a table goes by the options of the table, not by those of the write.
        f"OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY ({BUCKET}) LOCATION '{path}' "
        f"TBLPROPERTIES ('{_COUNT}' = '{buckets}', '{_KEYS}' = '{','.join(keys)}', '{_ASIDE}' = '{path}.folds')"
    )


def layout(spark: SparkSession, name: str) -> Layout | None:
    """How a table is bucketed; None if it is not."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if _COUNT not in found:
        return None
    schema = spark.table(name).drop(BUCKET).schema
    return Layout(int(found[_COUNT]), tuple(found[_KEYS].split(",")), schema, found[_ASIDE], found.get(_LABEL))


def touched_buckets(rows: DataFrame, how: Layout) -> list[int]:
    """The buckets that the keys of ``rows`` fall into; at most as many numbers as there are buckets."""
    return sorted(r[0] for r in rows.select(how.bucket()).distinct().collect())


def in_buckets(spark: SparkSession, name: str, buckets: Sequence[int]) -> DataFrame:
    """The rows of some buckets, without the bucket; the files of the others are not read."""
    rows = spark.table(name)
    return rows.where(F.col(BUCKET).isin(*buckets) if buckets else F.lit(False)).drop(BUCKET)


def _on(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    place, fs = _on(spark, path)
    return fs.exists(place)


def _noted(spark: SparkSession, path: str) -> list[int]:
    """The buckets of a fold, from the names of empty folders; none were made if it touched no bucket."""
    place, fs = _on(spark, path)
    if not fs.exists(place):
        return []
    return sorted(int(status.getPath().getName()) for status in fs.listStatus(place))


def fold_buckets(
    spark: SparkSession, name: str, touched: Callable[[], Sequence[int]], step: Callable[[DataFrame], DataFrame], label: str
) -> list[int]:
    """Replaces the rows of the touched buckets by ``step(rows)``; gives the buckets.

    ``step`` must give rows of those buckets only. A label that was folded last is not folded again; one that was
    interrupted goes on from the rows written aside.
    """
    spark.catalog.refreshTable(name)
    how = layout(spark, name)
    if how is None:
        raise ValueError(f"{name} is not bucketed")
    aside = f"{how.aside}/{label}"
    if not _exists(spark, f"{aside}/rows/_SUCCESS"):
        if how.label == label:
            return []
        numbers = list(touched())
        _forget(spark, f"{aside}/touched")
        for number in numbers:
            place, fs = _on(spark, f"{aside}/touched/{number}")
            fs.mkdirs(place)
        now = step(in_buckets(spark, name, numbers))
        now = now.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in how.schema]).withColumn(BUCKET, how.bucket())
        # Rows of a bucket lie together in few files; a bucket that holds much is split over several tasks.
        now.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{aside}/rows")
    numbers = _noted(spark, f"{aside}/touched")
    if how.label != label:
        left = [n for n in numbers if _exists(spark, f"{aside}/rows/{BUCKET}={n}")]
        if left:
            now = spark.read.schema(spark.table(name).schema).parquet(f"{aside}/rows")
            now.hint("rebalance", BUCKET).write.insertInto(name, overwrite=True)
        for number in sorted(set(numbers) - set(left)):
            _drop_bucket(spark, name, number)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_LABEL}' = '{label}')")
        spark.catalog.refreshTable(name)
        if how.label is not None:
            _forget(spark, f"{how.aside}/{how.label}")
    return numbers


def _drop_bucket(spark: SparkSession, name: str, bucket: int) -> None:
    """Removes a bucket with its files; the catalog alone would keep those of a table with a place of its own."""
    place = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({BUCKET} = {bucket})")
    _forget(spark, f"{place.rstrip('/')}/{BUCKET}={bucket}")


def _forget(spark: SparkSession, path: str) -> None:
    place, fs = _on(spark, path)
    fs.delete(place, True)
