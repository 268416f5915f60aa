"""Row counts, and the comparison of tables by counts and by content."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def reconcile(pairs: Iterable[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Rows in the raw and the staging copy of each named table, and the difference.

    Every count is a one-row aggregate of its own table; only those rows are combined.
    """

    def counted(name: str, df: DataFrame, side: str) -> DataFrame:
        n = F.count("*")
        zero = F.lit(0).cast("long")
        return df.agg(
            (n if side == "raw" else zero).alias("raw_rows"),
            (n if side == "staging" else zero).alias("staging_rows"),
        ).select(F.lit(name).alias("table_name"), "raw_rows", "staging_rows")

    counts = [
        counted(name, df, side)
        for name, raw, staging in pairs
        for side, df in (("raw", raw), ("staging", staging))
    ]
    return (
        reduce(DataFrame.unionByName, counts)
        .groupBy("table_name")
        .agg(F.sum("raw_rows").alias("raw_rows"), F.sum("staging_rows").alias("staging_rows"))
        .withColumn("diff", F.col("raw_rows") - F.col("staging_rows"))
    )


#: Buckets by key that two tables are first compared in.
CONTENT_BUCKETS = 1024


def _checksums(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int, side: str) -> DataFrame:
    """Per bucket of keys the number of rows and two order-free sums over hashes of whole rows."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")
    hashed = rows.select(bucket, F.xxhash64(*columns).alias("h"), F.xxhash64(F.lit(1), *columns).alias("g"))
    return hashed.groupBy("bucket").agg(
        F.struct(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.bit_xor("g").alias("xor")).alias(side)
    )


def content_differences(left: DataFrame, right: DataFrame, key: str | Sequence[str], buckets: int = CONTENT_BUCKETS) -> DataFrame:
    """Rows that one table has oftener than the other: the row, ``left_rows`` and ``right_rows``.

    Both are first reduced to checksums per bucket of their key, one short row per bucket and task. Only the rows of
    buckets whose checksums differ are compared themselves, so tables that agree are never shuffled, and a difference
    of some rows costs the buckets they are in. Columns are those of ``left``, in its types; equal rows count.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = left.columns
    typed = right.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in left.schema])
    sums = [_checksums(rows, keys, columns, buckets, side) for rows, side in ((left, "l"), (typed, "r"))]
    differ = sums[0].join(sums[1], "bucket", "full").where(~F.col("l").eqNullSafe(F.col("r"))).select("bucket")
    numbers = [r[0] for r in differ.collect()]  # at most as many as there are buckets
    own = F.pmod(F.xxhash64(*keys), F.lit(buckets)).isin(*numbers) if numbers else F.lit(False)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    both = left.where(own).select(*columns, one.alias("left_rows"), zero.alias("right_rows")).unionByName(
        typed.where(own).select(*columns, zero.alias("left_rows"), one.alias("right_rows"))
    )
    counted = both.groupBy(*columns).agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))
    return counted.where("left_rows <> right_rows")


def count_from_footers(spark: SparkSession, path: str) -> DataFrame:
    """``row_count`` of Parquet files from their footers; no column of them is read.

    The aggregate is pushed into Spark's own Parquet reader of the newer kind, in a session of its own with that setting.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.count("*").alias("row_count"))
