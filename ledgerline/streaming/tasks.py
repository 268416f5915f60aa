"""Tasks: streaming queries that move changes along on a schedule and can stop and resume."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.changes import META
from ledgerline.streaming.runlog import FAILED, SKIPPED, SUCCEEDED, RunLog
from ledgerline.streaming.sink import BatchSink

#: Gives None, or a remark for the run log.
Work = Callable[[DataFrame, str], str | None]


class Task:
    """A named unit of work over each range of new rows of a stream.

    The checkpoint holds the position: it advances once per micro-batch, after the work is done, and
    a restarted task goes on from there. ``work`` gets the new rows and a label that is the same when
    a batch is retried, to make its writes repeatable. The label names the checkpoint's own id, so the
    batches of a task with a new checkpoint are never taken for retries of the old one's.

    ``every`` is a period such as ``"5 minutes"``; without one the task runs on what is there and
    ends. No batch comes without new files; with ``skip_empty`` files without rows are passed over as
    well, which takes a look for a first row, so use it where that is cheap.
    """

    def __init__(
        self,
        name: str,
        stream: DataFrame,
        work: Work,
        checkpoint: str,
        every: str | None = None,
        skip_empty: bool = False,
        run_log: RunLog | None = None,
        output_mode: str = "append",
    ):
        self.name = name
        self.stream = stream
        self.work = work
        self.checkpoint = checkpoint
        self.every = every
        self.skip_empty = skip_empty
        self.run_log = run_log
        self.output_mode = output_mode
        self.query: StreamingQuery | None = None
        self._id: str | None = None

    def _checkpoint_id(self, spark: SparkSession) -> str:
        """The id that Spark gave the checkpoint when it was made; it is kept there over restarts."""
        if self._id is None:
            line = spark.read.text(f"{self.checkpoint.rstrip('/')}/metadata").first()[0]
            self._id = json.loads(line)["id"]
        return self._id

    def start(self) -> StreamingQuery:
        """Starts or resumes the task."""
        if self.query is not None and self.query.isActive:
            return self.query
        trigger = {"processingTime": self.every} if self.every else {"availableNow": True}
        self.query = (
            self.stream.writeStream.outputMode(self.output_mode)
            .queryName(self.name)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**trigger)
            .foreachBatch(self._run)
            .start()
        )
        return self.query

    def stop(self) -> None:
        """Suspends the task; :meth:`start` continues where it stopped."""
        if self.query is not None:
            self.query.stop()

    def run(self) -> None:
        """Works off everything that is there now and returns when it is done."""
        if self.every is None:
            self.start().awaitTermination()
        else:
            self.start().processAllAvailable()

    def _run(self, batch: DataFrame, batch_id: int) -> None:
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        label = f"{self.name}-{self._checkpoint_id(batch.sparkSession)}-{batch_id}"
        try:
            if self.skip_empty and batch.isEmpty():
                self._record(SKIPPED, started, label)
                return
            note = self.work(batch, label)
        except Exception as error:
            self._record(FAILED, started, label, str(error))
            raise
        self._record(SUCCEEDED, started, label, note)

    def _record(
        self, state: str, started: dt.datetime, label: str, error: str | None = None
    ) -> None:
        if self.run_log is not None:
            self.run_log.record(self.name, state, started, label, error)


def load_task(
    name: str,
    changes: DataFrame,
    target: BatchSink,
    checkpoint: str,
    every: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    **options,
) -> Task:
    """Appends each range of new changes to a table, optionally through a projection.

    Without a ``transform`` the change columns are dropped and the rows go over as they are.
    """
    project = transform or (lambda rows: rows.drop(*META))
    return Task(
        name,
        changes,
        lambda batch, label: target.append(project(batch), label),
        checkpoint,
        every,
        **options,
    )


def summary_task(
    name: str,
    trigger: DataFrame,
    build: Callable[[], DataFrame],
    append: Callable[[DataFrame, str], None],
    checkpoint: str,
    every: str | None = None,
    **options,
) -> Task:
    """Computes a whole summary again whenever there are changes and hands it to ``append``.

    With an appending sink each run adds a full copy of the summary, which its reader then adds up
    once per run; give a function that replaces the table to keep one copy.
    """
    return Task(name, trigger, lambda _, label: append(build(), label), checkpoint, every, **options)
