"""CSV file drops: format, location, listing, and loads that keep or refuse bad rows.

Fields are read as text and converted in the same pass, because the reader alone knows only one NULL
token and drops a row on its first unconvertible field without saying why.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import (
    DataType,
    DecimalType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

from ledgerline.schemas import is_whole_number, with_scale

CORRUPT = "_corrupt_record"
REASON = "_reject_reason"
RECORD = "_record"
FILE = "_file"

ABORT, CONTINUE = "abort", "continue"


@dataclass(frozen=True)
class CsvFormat:
    """How the files of a location are written.

    ``null_tokens`` are texts that stand for NULL, besides the empty unquoted field. Without a
    ``quote`` character, quotes are part of the value. ``multiline`` allows line breaks inside quoted
    fields; such files cannot be split, so one task reads a whole file.
    """

    sep: str = ","
    header: bool = False
    quote: str | None = None
    null_tokens: tuple[str, ...] = ("\\N",)
    trim: bool = False
    multiline: bool = False

    def options(self) -> dict[str, str]:
        quote = self.quote or ""
        return {
            "sep": self.sep,
            "header": str(self.header).lower(),
            "quote": quote,
            # A doubled quote stands for a quote; without quoting there is nothing to escape.
            "escape": quote or "\0",
            "ignoreLeadingWhiteSpace": str(self.trim).lower(),
            "ignoreTrailingWhiteSpace": str(self.trim).lower(),
            "multiLine": str(self.multiline).lower(),
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT,
            # Rows with too few or too many fields only show when all columns are parsed.
            "columnPruning": "false",
            "recursiveFileLookup": "true",
        }


def _literal(name: str) -> str:
    """A name in which no character has a meaning in path patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", name)


@dataclass(frozen=True)
class Source:
    """A location and the format of the files below it."""

    path: str
    fmt: CsvFormat = CsvFormat()

    def files(self, file: str | None = None, prefix: str | None = None) -> str:
        """Path of the whole location, of the one file ``file``, or of all whose name starts with ``prefix``.

        Names are taken as they are: characters with a meaning in patterns stand for themselves.
        """
        base = self.path.rstrip("/")
        if file is not None and prefix is not None:
            raise ValueError("give a file or a prefix, not both")
        if file is not None:
            return f"{base}/{_literal(file.rstrip('/'))}"
        return base if prefix is None else f"{base}/{_literal(prefix.rstrip('/'))}*"


class Loaded(NamedTuple):
    """Typed rows, and the refused ones with their text, file and reason."""

    rows: DataFrame
    rejects: DataFrame


class LoadResult(NamedTuple):
    rows_loaded: int
    rows_rejected: int


def list_files(
    spark: SparkSession, source: Source, file: str | None = None, prefix: str | None = None
) -> DataFrame:
    """Path, size and time of the files of a location; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(source.files(file, prefix))
        .select("path", "length", F.col("modificationTime").alias("last_modified"))
    )


def text_schema(schema: StructType) -> StructType:
    """All columns as text, plus the column that receives rows with a wrong field count."""
    names = [*schema.fieldNames(), CORRUPT]
    return StructType([StructField(name, StringType()) for name in names])


def configure(
    reader: DataFrameReader | DataStreamReader, source: Source, schema: StructType
) -> DataFrameReader | DataStreamReader:
    return reader.schema(text_schema(schema)).options(**source.fmt.options())


def _converted(text: Column, dtype: DataType) -> Column:
    """The text as ``dtype``, or NULL if it is none; fractions round half-up into whole numbers."""
    if isinstance(dtype, (StringType, VarcharType)):
        return text
    if is_whole_number(dtype):
        return text.try_cast(DecimalType(38, 0)).try_cast(dtype)
    return text.try_cast(dtype)


def _problem(name: str, text: Column, typed: Column, dtype: DataType) -> Column:
    wrong = typed.isNull() & text.isNotNull()
    if isinstance(dtype, VarcharType):
        wrong = F.char_length(text) > dtype.length
    label = f"{name} is not a {dtype.simpleString()}: "
    return F.when(wrong, F.concat(F.lit(label), text))


def parse(
    raw: DataFrame, schema: StructType, fmt: CsvFormat, numeric_scale: int | None = None
) -> DataFrame:
    """Text rows to typed rows, with the reason in ``_reject_reason`` where a row is bad."""
    target = with_scale(schema, numeric_scale)
    tokens = list(fmt.null_tokens)
    texts = {
        f.name: F.when(~F.col(f.name).isin(tokens), F.col(f.name)) if tokens else F.col(f.name)
        for f in target
    }
    typed = {f.name: _converted(texts[f.name], f.dataType) for f in target}
    problems = [
        F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of fields")),
        *[_problem(f.name, texts[f.name], typed[f.name], f.dataType) for f in target],
    ]
    fields = F.to_csv(F.struct(*[F.col(f.name) for f in target]), {"sep": fmt.sep})
    return raw.select(
        *[column.alias(name) for name, column in typed.items()],
        F.coalesce(*problems).alias(REASON),
        F.coalesce(F.col(CORRUPT), fields).alias(RECORD),
        F.col("_metadata.file_path").alias(FILE),
    )


def good_rows(parsed: DataFrame, on_error: str = ABORT) -> DataFrame:
    """The typed rows: without the bad ones, or failing the job on the first of them."""
    good = F.col(REASON).isNull()
    if on_error == ABORT:
        message = F.concat(F.col(FILE), F.lit(": "), F.col(REASON), F.lit(" in "), F.col(RECORD))
        good = F.when(good, True).otherwise(F.raise_error(message).cast("boolean"))
    elif on_error != CONTINUE:
        raise ValueError(f"on_error must be {ABORT!r} or {CONTINUE!r}, not {on_error!r}")
    return parsed.where(good).drop(REASON, RECORD, FILE)


def rejected_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNotNull()).select(FILE, RECORD, REASON)


def read_parsed(
    spark: SparkSession,
    source: Source,
    schema: StructType,
    file: str | None = None,
    numeric_scale: int | None = None,
    prefix: str | None = None,
) -> DataFrame:
    return _parse_paths(spark, source, schema, [source.files(file, prefix)], numeric_scale)


def _parse_paths(
    spark: SparkSession,
    source: Source,
    schema: StructType,
    paths: list[str],
    numeric_scale: int | None,
) -> DataFrame:
    raw = configure(spark.read, source, schema).csv(paths)
    return parse(raw, schema, source.fmt, numeric_scale)


def load_csv(
    spark: SparkSession,
    source: Source,
    schema: StructType,
    file: str | None = None,
    on_error: str = ABORT,
    numeric_scale: int | None = None,
    prefix: str | None = None,
) -> Loaded:
    """Rows of one ``file``, of all files whose name starts with ``prefix``, or of the whole location.

    ``abort`` fails the job that reads the rows when there is a bad one, so a load writes all rows or
    none; ``continue`` leaves bad rows out and offers them as ``rejects``. ``numeric_scale`` keeps
    that many digits in unscaled numbers, which otherwise round to whole ones.
    """
    parsed = read_parsed(spark, source, schema, file, numeric_scale, prefix)
    return Loaded(good_rows(parsed, on_error), rejected_rows(parsed))


def write_parsed(
    parsed: DataFrame,
    write: Callable[[DataFrame], object],
    on_error: str = ABORT,
    put_aside: Callable[[DataFrame], object] | None = None,
) -> LoadResult:
    """Writes the good rows with ``write`` and the bad ones, if there are any, with ``put_aside``.

    Bad rows are counted while the good ones are written; the files are read a second time only when
    there is something to put aside.
    """
    observed = Observation()
    counted = parsed.observe(
        observed,
        F.count(F.when(F.col(REASON).isNull(), 1)).alias("good"),
        F.count(REASON).alias("bad"),
    )
    write(good_rows(counted, on_error))
    result = LoadResult(observed.get["good"], observed.get["bad"])
    if result.rows_rejected and put_aside is not None:
        put_aside(rejected_rows(parsed))
    return result


class LoadHistory:
    """Which file versions have been loaded into which table, as a parquet folder."""

    SCHEMA = "table_name string, path string, last_modified timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        spark.createDataFrame([], self.SCHEMA).write.mode("append").parquet(self.path)

    def loaded(self, table: str) -> DataFrame:
        known = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        return known.where(F.col("table_name") == table).drop("table_name")

    def new_files(self, table: str, files: DataFrame) -> list[Row]:
        """Listed files that were not loaded yet, or were changed since."""
        return files.join(self.loaded(table), ["path", "last_modified"], "left_anti").collect()

    def record(self, table: str, files: list[Row]) -> None:
        rows = [(table, f["path"], f["last_modified"]) for f in files]
        self.spark.createDataFrame(rows, self.SCHEMA).write.mode("append").parquet(self.path)


def copy_into(
    spark: SparkSession,
    source: Source,
    schema: StructType,
    table: str,
    file: str | None = None,
    on_error: str = ABORT,
    numeric_scale: int | None = None,
    rejects_path: str | None = None,
    history: LoadHistory | None = None,
    prefix: str | None = None,
) -> LoadResult:
    """Appends the rows of a file set to a table, by position.

    With a ``history``, files that were loaded into the table before are passed over. It is written
    after the rows, so a crash in between repeats the load; the ingest stream has no such gap.
    """
    if history is None:
        parsed = read_parsed(spark, source, schema, file, numeric_scale, prefix)
    else:
        files = history.new_files(table, list_files(spark, source, file, prefix))
        if not files:
            return LoadResult(0, 0)
        paths = [f["path"] for f in files]
        parsed = _parse_paths(spark, source, schema, paths, numeric_scale)

    def put_aside(rejects: DataFrame) -> None:
        if rejects_path is not None:
            rejects.write.mode("append").parquet(rejects_path)

    result = write_parsed(
        parsed, lambda rows: rows.write.insertInto(table), on_error, put_aside
    )
    if history is not None:
        history.record(table, files)
    return result
