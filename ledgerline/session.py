"""Session settings and the shared folder for jobs that write."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job is designed for. AQE splits skewed join partitions, turns a sort-merge join into
#: a broadcast join when the measured side is small, and coalesces small shuffle partitions. It measures
#: compressed bytes, and the rows of one hot key compress well, so partitions count as skewed earlier
#: than by default. Streaming state is kept in RocksDB, on disk, so that it may outgrow the executors'
#: memory.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Shuffle partition count that keeps one partition near 128 MiB and every core busy.

    AQE only ever merges or splits what it is given, so for a large job set
    ``spark.sql.shuffle.partitions`` to this before starting the session.
    """
    by_size = math.ceil(shuffle_bytes / _TARGET_PARTITION_BYTES)
    return max(by_size, cores, 1)


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ledgerline")
    settings = {
        **JOB_CONF,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` session may go without the setting: there one machine holds the driver and all
    tasks, so a temporary folder is made for it. On a cluster the setting is required.
    """
    configured = (
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A not yet existing path below :func:`shared_dir`, different on every call."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that it is computed once whatever happens to executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
