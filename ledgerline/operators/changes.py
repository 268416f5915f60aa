"""Reading a change log: ranges, net changes, past states, and applying changes to a table.

A change log is an append-only frame with one row image per change:

* ``op``: ``INSERT``, ``UPDATE`` (new image) or ``DELETE`` (last image),
* ``seq``: the position, growing with every commit,
* ``commit_ts``: when it was committed,
* ``row_no``, if there is one: the order of the changes within a commit; a log without it has each key
  at most once at a position,
* the columns of the logged table.

The latest image per key is found with ``max_by``, never with a window: it is combined on the map
side, so a key that owns a third of the log sends one row per map task instead of all its rows to a
single sort. Images hold text, so Spark aggregates them by sorting: each map task sorts its own part of
the log, in memory or with spilling, before it ships one row per key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.session import stored

OP, SEQ, COMMIT_TS, ROW = "op", "seq", "commit_ts", "row_no"
META = (OP, SEQ, COMMIT_TS, ROW)
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
ACTION, IS_UPDATE, ROW_COUNT = "action", "is_update", "row_count"
LIVE = "live"


def payload_columns(log: DataFrame) -> list[str]:
    return [c for c in log.columns if c not in META]


def _order(log: DataFrame) -> Column:
    """What puts the changes of one key in order."""
    return F.struct(SEQ, ROW) if ROW in log.columns else F.col(SEQ)


def _sign(rows: DataFrame, marker: str) -> Column:
    """-1 for a deleted row and 1 for an inserted one; an update without its old image is refused."""
    refused = F.raise_error(F.lit("an UPDATE has no old image: log it as DELETE and INSERT, or use split_updates"))
    return (
        F.when(F.col(marker) == DELETE, -1)
        .when(F.col(marker) == UPDATE, refused.cast("int"))
        .otherwise(1)
    )


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def changes(log: DataFrame, since: int, until: int | None = None) -> DataFrame:
    """Log rows after position ``since``, up to and including ``until``."""
    later = log.where(F.col(SEQ) > since)
    return later if until is None else later.where(F.col(SEQ) <= until)


def pending_changes(log: DataFrame, since: int) -> DataFrame:
    """One row with the number of changes not consumed yet."""
    return changes(log, since).agg(F.count("*").alias("pending_changes"))


def position_at(log: DataFrame, ts: dt.datetime | dt.date | str) -> int:
    """The last position committed before ``ts``; -1 when there is none."""
    return (
        log.where(F.col(COMMIT_TS) < _timestamp(log, ts))
        .agg(F.coalesce(F.max(SEQ), F.lit(-1)))
        .first()[0]
    )


def _timestamp(log: DataFrame, ts: dt.datetime | dt.date | str) -> Column:
    # A literal of the column's own type: no cast on the column, so the filter reaches the scan.
    return F.lit(str(ts)).cast(log.schema[COMMIT_TS].dataType)


def latest_images(log: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The last logged image per key with a ``live`` flag, false where it is a delete."""
    keys = _keys(key)
    payload = payload_columns(log)
    image = F.struct(_live(), *[c for c in payload if c not in keys])
    return (
        log.groupBy(*keys)
        .agg(F.max_by(image, _order(log)).alias("_last"))
        .select(*[c if c in keys else F.col(f"_last.{c}") for c in payload], f"_last.{LIVE}")
    )


def _live() -> Column:
    return (F.col(OP) != DELETE).alias(LIVE)


def _live_rows(log: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return latest_images(log, key).where(LIVE).drop(LIVE)


def state_at(log: DataFrame, key: str | Sequence[str], seq: int | None = None) -> DataFrame:
    """The logged table as it was right after position ``seq`` (default: now)."""
    return _live_rows(log if seq is None else log.where(F.col(SEQ) <= seq), key)


def as_of(
    log: DataFrame,
    key: str | Sequence[str],
    ts: dt.datetime | str | None = None,
    offset_s: int = 0,
    base: DataFrame | None = None,
    since: int = -1,
) -> DataFrame:
    """The logged table as it was ``offset_s`` seconds before ``ts`` (default: now).

    With ``base``, the stored rows at an earlier position ``since``, only the changes after it are read
    and applied to them; without one the log is replayed from its start.
    """
    dtype = log.schema[COMMIT_TS].dataType
    now = F.current_timestamp().cast(dtype) if ts is None else _timestamp(log, ts)
    cut = F.timestamp_add("SECOND", F.lit(-offset_s), now)
    known = log.where(F.col(COMMIT_TS) <= cut)
    return _live_rows(known, key) if base is None else apply_changes(base, changes(known, since), key)


def net_changes(
    log: DataFrame,
    key: str | Sequence[str],
    since: int,
    until: int | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """What changed between two positions, each key at most once as INSERT, DELETE or an update.

    An update is a DELETE of the old row plus an INSERT of the new one, both with ``is_update``; a
    key inserted and deleted in between, or back at its old values, does not appear.

    From the log alone, both states come out of one aggregation: one scan, one shuffle, no join. That
    reads the log from its start; with ``base``, the stored rows at position ``since``, only the
    changes in between are read, and ``base`` is filtered by their keys.
    """
    keys = _keys(key)
    rest = [c for c in payload_columns(log) if c not in keys]
    image = F.struct(_live(), *rest)
    if base is None:
        known = log if until is None else log.where(F.col(SEQ) <= until)
        both = known.groupBy(*keys).agg(
            F.max_by(image, F.when(F.col(SEQ) <= since, _order(log))).alias("old"),
            F.max_by(image, _order(log)).alias("new"),
        )
    else:
        now = changes(log, since, until).groupBy(*keys).agg(F.max_by(image, _order(log)).alias("new"))
        touched = now.select(*[F.col(k).alias(f"_c_{k}") for k in keys])
        old = base.join(touched, _same_keys(base, touched, keys), "left_semi").select(
            *[F.col(k).alias(f"_c_{k}") for k in keys],
            F.struct(F.lit(True).alias(LIVE), *rest).alias("old"),
        )
        both = now.join(old, _same_keys(now, old, keys), "left").select(*keys, "old", "new")
    return _differences(both, keys, payload_columns(log))


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of each key of ``left`` with its ``_c_`` copy in ``right``."""
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[f"_c_{k}"]) for k in keys]
    )


def _differences(both: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Rows of change from frames with the ``old`` and the ``new`` image per key."""
    rest = [c for c in payload if c not in keys]
    was, now = (F.coalesce(F.col(f"{side}.{LIVE}"), F.lit(False)) for side in ("old", "new"))
    changed = (was != now) | (was & now & ~F.col("old").eqNullSafe(F.col("new")))

    def side(name: str, action: str) -> Column:
        return F.struct(
            F.lit(action).alias(ACTION),
            (was & now).alias(IS_UPDATE),
            *[F.col(f"{name}.{c}").alias(c) for c in rest],
        )

    rows = F.filter(
        F.array(F.when(was, side("old", DELETE)), F.when(now, side("new", INSERT))),
        lambda row: row.isNotNull(),
    )
    return (
        both.where(changed)
        .select(*keys, F.explode(rows).alias("row"))
        .select(
            *[c if c in keys else F.col(f"row.{c}") for c in payload],
            F.col(f"row.{ACTION}"),
            F.col(f"row.{IS_UPDATE}"),
        )
    )


#: The number of a log's range, as :func:`split_updates` keeps it, and the row before it of the same key.
_RANGE, _OLD = "_range", "_old"


def split_updates(log: DataFrame, key: str | Sequence[str], ranges: int | None = None) -> DataFrame:
    """The log with every update as a DELETE of the key's row before and an INSERT of the new one.

    Inserts of a key that is there count as updates, and deletes of one that is not as nothing, so sums
    over the result follow the table. A writer that knows the old image does better to log both.

    The log is cut into ``ranges`` by key and position and kept so in the shared folder. A key with a third of
    all changes goes over many ranges, and each range is put in order by itself. What a range does not have, the row
    before its first one, is the last row of the nearest range before it, if that is of the same key; so one row
    for each range is carried over, whatever the number of changes.
    """
    keys = _keys(key)
    rest = [c for c in payload_columns(log) if c not in keys]
    extra = [c for c in META if c in log.columns and c != OP]
    order = [c for c in (SEQ, ROW) if c in log.columns]
    spark = log.sparkSession
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = log.repartitionByRange(count, *keys, *order).withColumn(_RANGE, F.spark_partition_id())
    cut = stored(cut, "log-ranges")
    image = F.struct((F.col(OP) != DELETE).alias(LIVE), *rest)
    in_range = Window.partitionBy(_RANGE, *keys).orderBy(*order)
    told = cut.withColumn(_OLD, F.lag(image).over(in_range)).withColumn("_first", F.row_number().over(in_range) == 1)
    carried = _carried(cut, keys, order, image)
    same = reduce(lambda a, b: a & b, [told[k].eqNullSafe(carried[f"_c_{k}"]) for k in keys])
    before = (told[_RANGE] == carried["_c_range"]) & told["_first"] & same
    # At most one row for each range: Spark broadcasts it, as it sees by its size.
    with_old = told.join(carried, before, "left").withColumn(_OLD, F.coalesce(_OLD, "_c_image"))
    was = F.coalesce(F.col(f"{_OLD}.{LIVE}"), F.lit(False))
    old = F.struct(F.lit(DELETE).alias(OP), *[F.col(f"{_OLD}.{c}").alias(c) for c in rest])
    new = F.struct(F.lit(INSERT).alias(OP), *rest)
    pair = F.filter(
        F.array(F.when(was, old), F.when(F.col(OP) != DELETE, new)), lambda row: row.isNotNull()
    )
    return with_old.select(*keys, *extra, F.explode(pair).alias("_row")).select(
        *[c if c in keys or c in extra else F.col(f"_row.{c}").alias(c) for c in log.columns]
    )


def _carried(cut: DataFrame, keys: list[str], order: list[str], image: Column) -> DataFrame:
    """For each range its ``_c_range``, with the last row of the nearest range before it that has any."""
    place = F.struct(*keys, *order)
    last = cut.groupBy(_RANGE).agg(F.max_by(F.struct(*keys, image.alias("image")), place).alias("last"))
    last = stored(last, "log-range-ends")
    # One row a range: the pairs of ranges in order are as many as there are ranges.
    earlier = last.select(F.col(_RANGE).alias("_c_range"), F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy(_RANGE)).alias("before"))
    return earlier.where("before is not null").select(
        "_c_range", *[F.col(f"before.{k}").alias(f"_c_{k}") for k in keys], F.col("before.image").alias("_c_image")
    )


def net_row_changes(log: DataFrame, since: int, until: int | None = None) -> DataFrame:
    """Net change of a table without a key, from a log that holds only INSERT and DELETE images.

    Equal rows cannot be told apart, so each distinct row appears once with its ``row_count``; rows
    inserted and deleted equally often do not appear.
    """
    payload = payload_columns(log)
    sign = _sign(log, OP)
    net = changes(log, since, until).groupBy(*payload).agg(F.sum(sign).alias("_net"))
    return net.where(F.col("_net") != 0).select(
        *payload,
        F.when(F.col("_net") > 0, INSERT).otherwise(DELETE).alias(ACTION),
        F.lit(False).alias(IS_UPDATE),
        F.abs("_net").alias(ROW_COUNT),
    )


def rows_after(log: DataFrame) -> DataFrame:
    """The rows of a table without a key after all logged changes, with their ``row_count``."""
    net = net_row_changes(log, since=-1).where(F.col(ACTION) == INSERT)
    return net.drop(ACTION, IS_UPDATE)


def apply_changes(target: DataFrame, log: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``target`` with logged changes applied: updated, inserted and deleted by key.

    Rows of untouched keys pass through an anti join. As long as the changed keys fit the broadcast
    limit, which Spark checks against their measured size, the target is not shuffled at all; beyond
    it the join is a sort-merge join whose skewed partitions AQE splits.
    """
    keys = _keys(key)
    last = latest_images(log, keys)
    touched = last.select(*[F.col(k).alias(f"_c_{k}") for k in keys])
    untouched = target.join(touched, _same_keys(target, touched, keys), "left_anti")
    upserts = last.where(LIVE).select(*target.columns)
    return untouched.unionByName(upserts)


def keep_after_delete(df: DataFrame, condition: Column) -> DataFrame:
    """What ``DELETE WHERE condition`` leaves: rows where it is false or unknown."""
    return df.where(~F.coalesce(condition, F.lit(False)))
