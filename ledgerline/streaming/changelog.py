"""A change log kept as parquet folders, one per commit.

``<path>/seq=<n>/writer=<label>/`` holds the row images of commit ``n``. Batch jobs read it through
partition pruning on ``seq``; streaming jobs read it as a file source and find new commits by
themselves.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ledgerline.operators.changes import COMMIT_TS, META, OP, ROW, SEQ
from ledgerline.schemas import frame_schema

_WRITER = "writer"
#: Below a log or sink; names with an underscore are passed over by every reader.
_UNFINISHED = "_unfinished"


def _on(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a folder was published; only complete ones ever are."""
    place, fs = _on(spark, path)
    return fs.exists(place)


def publish(rows: DataFrame, base: str, folder: str) -> None:
    """Writes rows aside and then renames them to ``folder`` below ``base``, in one step.

    So batch readers and streams see the whole folder or nothing, and a crash leaves at most an
    unfinished folder that nobody reads. The store must rename folders atomically, as HDFS does.
    """
    spark = rows.sparkSession
    aside = f"{base}/{_UNFINISHED}/{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    target, fs = _on(spark, folder)
    fs.mkdirs(target.getParent())
    if not fs.exists(target) and not fs.rename(_on(spark, aside)[0], target):
        raise OSError(f"could not publish {folder}")


def folders(spark: SparkSession, pattern: str) -> list[str]:
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return [status.getPath().toString() for status in found or []]


class ChangeLog:
    """The log of one table. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, path: str, row_schema: StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.rows = frame_schema(row_schema)
        meta = [
            StructField(OP, StringType()),
            StructField(COMMIT_TS, TimestampType()),
            StructField(SEQ, LongType()),
            StructField(ROW, LongType()),
            StructField(_WRITER, StringType()),
        ]
        self.schema = StructType(self.rows.fields + meta)

    def _commits(self) -> list[tuple[int, str]]:
        """Positions and writers of the commits, from the folder names alone."""
        found = []
        for folder in folders(self.spark, f"{self.path}/{SEQ}=*/{_WRITER}=*"):
            seq, writer = folder.rsplit("/", 2)[1:]
            found.append((int(seq.split("=", 1)[1]), writer.split("=", 1)[1]))
        return found

    def position(self) -> int:
        """The last position written; -1 for an empty log."""
        return max((seq for seq, _ in self._commits()), default=-1)

    def has(self, writer: str) -> bool:
        """Whether the commit with this writer label is complete."""
        return any(
            committed(self.spark, self._folder(seq, label))
            for seq, label in self._commits()
            if label == writer
        )

    def _folder(self, seq: int, writer: str) -> str:
        return f"{self.path}/{SEQ}={seq}/{_WRITER}={writer}"

    def commit(
        self,
        rows: DataFrame,
        op: str | None = None,
        commit_ts: dt.datetime | None = None,
        writer: str | None = None,
    ) -> int:
        """Adds rows as one commit and returns its position.

        ``op`` applies to all rows; without it they carry an ``op`` column. A repeated ``writer``
        label is the retry of an earlier commit: it keeps that position and writes nothing. A commit
        is published whole or not at all, so a reader never sees half of one, or one twice.

        Rows of one commit are applied in the order of their ``row_no``. Without such a column they are
        numbered in the order of the frame; give one when a key changes more than once in a commit.
        """
        label = writer or uuid.uuid4().hex
        commits = self._commits()
        seq = next((s for s, w in commits if w == label), None)
        if seq is None:
            seq = max((s for s, _ in commits), default=-1) + 1
        folder = self._folder(seq, label)
        if not committed(self.spark, folder):
            when = F.current_timestamp() if commit_ts is None else F.lit(commit_ts)
            number = F.col(ROW) if ROW in rows.columns else F.monotonically_increasing_id()
            image = rows.select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.rows],
                (F.col(OP) if op is None else F.lit(op)).alias(OP),
                when.cast("timestamp").alias(COMMIT_TS),
                number.alias(ROW),
            )
            publish(image, self.path, folder)
        return seq

    def _columns(self) -> Sequence[str]:
        return [*self.rows.fieldNames(), *META]

    def read(self, since: int = -1, until: int | None = None) -> DataFrame:
        """Commits after position ``since`` up to ``until``; only their folders are listed."""
        wanted = [
            self._folder(seq, writer)
            for seq, writer in self._commits()
            if seq > since and (until is None or seq <= until)
        ]
        if not wanted:
            return self.spark.createDataFrame([], self.schema).select(*self._columns())
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        return reader.parquet(*wanted).select(*self._columns())

    def stream(self, max_files: int | None = None) -> DataFrame:
        """New commits as a stream; ``max_files`` bounds one micro-batch."""
        reader = self.spark.readStream.schema(self.schema)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path).select(*self._columns())
