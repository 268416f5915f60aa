"""Append target of a streaming task: one folder per micro-batch, written at most once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.streaming.changelog import committed, publish

BATCH = "_batch"


class BatchSink:
    """A parquet folder that several tasks and loads append to.

    Rows land in ``<path>/_batch=<label>/``, published whole. Streaming retries a micro-batch under the
    same label after a failure; a folder that is there is complete and left alone, so no row is
    appended twice and readers never see part of a batch.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def _folder(self, label: str) -> str:
        return f"{self.path}/{BATCH}={label}"

    def has(self, label: str) -> bool:
        """Whether a batch was appended completely."""
        return committed(self.spark, self._folder(label))

    def append(self, rows: DataFrame, label: str) -> None:
        if not self.has(label):
            columns = self.schema.fieldNames()
            publish(rows.select(*columns), self.path, self._folder(label))

    def read(self) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField(BATCH, StringType())])
        return self.spark.read.schema(schema).parquet(self.path).drop(BATCH)
