"""The edge of a report: bringing a small result to the client, and reusing it for a while."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import fresh_dir

# Fixed value: how long a report's result is reused, in seconds.
REPORT_TTL_S = 60
# Rows of a report in pages that the client holds at once.
REPORT_PAGE_ROWS = 100_000


def to_report(df: DataFrame, max_rows: int | None = None, as_objects: bool = False) -> pd.DataFrame:
    """A final aggregate as a pandas frame, all of it.

    With ``max_rows`` a result that is larger is refused, not cut. ``as_objects`` keeps Spark's own values:
    a whole number beside a NULL stays one, where pandas makes both floats.
    """
    result = df if max_rows is None else df.limit(max_rows + 1)
    if as_objects:
        report = pd.DataFrame(result.collect(), columns=df.columns, dtype=object)
    else:
        report = result.toPandas()
    if max_rows is not None and len(report) > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate further before reporting")
    return report


def _place(file: str) -> list[int]:
    """The task of a part file and its number there, by its name; both may outgrow their padding."""
    return [int(n) for n in re.search(r"part-(\d+)-.*-c(\d+)\.", file).groups()]


def report_pages(df: DataFrame, *order: Column | str, page_rows: int = REPORT_PAGE_ROWS) -> Iterator[pd.DataFrame]:
    """A final aggregate of any size, all of it in ``order``, as one frame after another of at most ``page_rows`` rows.

    It is stored in sorted files no larger than a page, and small neighbours are brought together, however many
    partitions there were; the client holds a single page at a time.
    """
    path = fresh_dir(df.sparkSession, "report")
    df.orderBy(*order).write.option("maxRecordsPerFile", page_rows).parquet(path)
    reader = df.sparkSession.read.schema(df.schema)
    sizes = reader.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).count().collect()
    pages, room = [[]], page_rows
    for file, rows in sorted(sizes, key=lambda size: _place(size["file"])):
        if rows > room:
            pages.append([])
            room = page_rows
        pages[-1].append(f"{path}/{file}")
        room -= rows
    for files in pages:
        page = reader.parquet(*files or [path]).coalesce(1).sortWithinPartitions(*order)
        yield to_report(page, page_rows, as_objects=True)


class CachedReport:
    """A DataFrame kept on the cluster and rebuilt when it is older than ``ttl_s``; None: never."""

    def __init__(self, build: Callable[[], DataFrame], ttl_s: float | None = REPORT_TTL_S):
        self.build = build
        self.ttl_s = ttl_s
        self._df: DataFrame | None = None
        self._built = 0.0

    def get(self) -> DataFrame:
        expired = self.ttl_s is not None and time.monotonic() - self._built > self.ttl_s
        if self._df is not None and expired:
            self.clear()
        if self._df is None:
            self._df = self.build().persist()
            self._built = time.monotonic()
        return self._df

    def clear(self) -> None:
        if self._df is not None:
            self._df.unpersist()
            self._df = None
