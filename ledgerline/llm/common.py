"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import fresh_dir

#: White space that parts words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    It is computed once, does not depend on earlier executors, and its size is known when a later join
    is planned.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array; none for a text of white space."""
    return F.filter(F.split(text, SPACES + "+"), lambda w: w != "")
