"""The run history of tasks: one row per run with its state and error."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.ordering import descending
from ledgerline.schemas import RUN_LOG
from ledgerline.streaming.changelog import folders

SUCCEEDED, FAILED, SKIPPED = "SUCCEEDED", "FAILED", "SKIPPED"


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def record(
        self,
        name: str,
        state: str,
        scheduled_time: dt.datetime,
        query_id: str,
        error_message: str | None = None,
    ) -> None:
        row = (name, state, scheduled_time, query_id, error_message)
        self.spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(
            self.path
        )

    def history(self, name: str | None = None) -> DataFrame:
        """Runs of one task or of all, latest first."""
        if folders(self.spark, f"{self.path}/part-*"):
            runs = self.spark.read.schema(RUN_LOG).parquet(self.path)
        else:
            runs = self.spark.createDataFrame([], RUN_LOG)
        if name is not None:
            runs = runs.where(F.col("name") == name)
        return runs.orderBy(descending("scheduled_time"))
