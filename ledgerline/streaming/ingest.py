"""Continuous load of arriving CSV files, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline.operators.changes import INSERT
from ledgerline.sources.csv_files import (
    CONTINUE,
    Source,
    configure,
    parse,
    rejected_rows,
    write_parsed,
)
from ledgerline.streaming.changelog import ChangeLog
from ledgerline.streaming.sink import BATCH, BatchSink
from ledgerline.streaming.tasks import Task


def csv_stream(
    spark: SparkSession,
    source: Source,
    schema: StructType,
    file: str | None = None,
    numeric_scale: int | None = None,
    max_files: int | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """Parsed rows of new files, with the reason where a row is bad."""
    reader = configure(spark.readStream, source, schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse(reader.csv(source.files(file, prefix)), schema, source.fmt, numeric_scale)


def ingest_stream(
    name: str,
    parsed: DataFrame,
    target: BatchSink | ChangeLog,
    checkpoint: str,
    every: str | None = None,
    on_error: str = CONTINUE,
    rejects_path: str | None = None,
    **options,
) -> Task:
    """A task that loads each new file of :func:`csv_stream` once.

    The number of rejected rows goes to the run log, if there is one. The checkpoint remembers the files seen. Without ``every`` it catches up with the files present
    and ends. Into a :class:`ChangeLog` the rows go as inserts, so that further tasks can follow them.
    """

    def write(rows: DataFrame, label: str) -> None:
        if isinstance(target, ChangeLog):
            target.commit(rows, INSERT, writer=label)
        else:
            target.append(rows, label)

    def work(batch: DataFrame, label: str) -> str | None:
        def put_aside(rejects: DataFrame) -> None:
            if rejects_path is not None:
                rejects.write.mode("overwrite").parquet(f"{rejects_path}/{BATCH}={label}")

        if target.has(label):
            # The retry of a batch that failed after its good rows were complete.
            put_aside(rejected_rows(batch))
            return None
        result = write_parsed(batch, lambda rows: write(rows, label), on_error, put_aside)
        if not result.rows_rejected:
            return None
        kept = "" if rejects_path is not None else ", not kept: there is no rejects path"
        return f"{result.rows_rejected} rows rejected{kept}"

    return Task(name, parsed, work, checkpoint, every, **{"skip_empty": True, **options})
