"""Stored results that are brought up to date within a lag of changes to their input."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.changes import apply_changes
from ledgerline.operators.stored_sums import merge_sums, partial_sums
from ledgerline.session import stored
from ledgerline.sources.buckets import layout
from ledgerline.sources.tables import create_in_buckets, fold_table, materialize, stored_rows, stored_version
from ledgerline.streaming.tasks import Task


def refresh(
    name: str,
    trigger: DataFrame,
    build: Callable[[], DataFrame],
    table: str,
    checkpoint: str,
    lag: str | None = None,
    **options,
) -> Task:
    """Recomputes ``build()`` into ``table`` at most ``lag`` after ``trigger`` shows new rows."""

    def work(_: DataFrame, label: str) -> None:
        materialize(build(), table, replace=True)

    return Task(name, trigger, work, checkpoint, lag, **options)


def refresh_sums(
    name: str,
    rows: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    table: str,
    checkpoint: str,
    lag: str | None = None,
    **options,
) -> Task:
    """A grouped aggregate of an append-only stream, kept in the streaming state.

    Each refresh reads only the new rows; they are combined per key on the map side before they reach
    the state. Only the keys that changed come out of it, and only the buckets they are in are rewritten.
    """

    def work(changed: DataFrame, label: str) -> None:
        spark = changed.sparkSession
        if stored_version(spark, table) == label:
            return
        now = stored(changed, "changed-sums")
        if not spark.catalog.tableExists(table):
            create_in_buckets(spark, table, now.schema, keys)
        same = reduce(and_, [F.col(f"old.{k}").eqNullSafe(F.col(f"now.{k}")) for k in keys])
        fold_table(
            spark, table, now, lambda rows: rows.alias("old").join(now.alias("now"), same, "left_anti").unionByName(now), label
        )

    return Task(
        name,
        rows.groupBy(*keys).agg(*aggregates),
        work,
        checkpoint,
        lag,
        output_mode="update",
        **options,
    )


def maintain_sums(
    name: str, changes: DataFrame, key: str, measure: str, table: str, checkpoint: str, **options
) -> Task:
    """Keeps partial sums per key up to date from logged inserts and deletes.

    The table is made in buckets by the key, and each batch rewrites only the buckets its keys are in. Read the
    sums with :func:`ledgerline.operators.stored_sums.read_sums`.
    """

    def work(batch: DataFrame, label: str) -> None:
        spark = batch.sparkSession
        if stored_version(spark, table) == label:
            return
        # One row per changed key, kept for the two passes over it.
        delta = stored(partial_sums(batch, key, measure), "sums-delta")
        if not spark.catalog.tableExists(table):
            create_in_buckets(spark, table, delta.schema, [key])
        fold_table(spark, table, delta, lambda rows: merge_sums(rows, delta, key), label)

    return Task(name, changes, work, checkpoint, **options)


def apply_task(
    name: str,
    changes: DataFrame,
    key: str | Sequence[str],
    table: str,
    checkpoint: str,
    **options,
) -> Task:
    """Keeps an existing table equal to the logged one: updated, inserted and deleted by key.

    Of a table that is bucketed by the key or a part of it, only the buckets of changed keys are rewritten; any
    other table is rewritten whole.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def work(batch: DataFrame, label: str) -> None:
        spark = batch.sparkSession
        if not spark.catalog.tableExists(table):
            raise ValueError(f"create {table} before changes are applied to it")
        if stored_version(spark, table) == label:
            return
        how = layout(spark, table)
        if how is None or not set(how.keys) <= set(keys):
            rows = apply_changes(stored_rows(spark, table), batch, key)
            if how is None:
                materialize(rows, table, replace=True, version=label)
                return
            raise ValueError(f"{table} is bucketed by {how.keys}, not by the key {keys}")
        fold_table(spark, table, batch, lambda rows: apply_changes(rows, batch, key), label)

    return Task(name, changes, work, checkpoint, **options)
