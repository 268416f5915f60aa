"""What must not get lost, be seen half, or be taken twice: labels, commits, changes within a commit."""

import datetime as dt

import random

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.masking import EMAIL_MASK, UNMASKED_ROLE
from ledgerline.operators import changes as cdc
from ledgerline.operators.stored_sums import partial_sums, read_sums
from ledgerline.sources import tables
from ledgerline.sources.csv_files import CsvFormat, Source, load_csv
from ledgerline.streaming.changelog import ChangeLog, publish
from ledgerline.streaming.ingest import csv_stream, ingest_stream
from ledgerline.streaming.refresh import maintain_sums
from ledgerline.streaming.runlog import RunLog
from ledgerline.streaming.sink import BatchSink
from ledgerline.streaming.tasks import load_task

ROWS = schemas.frame_schema(schemas.table(id=schemas.KEY, v=schemas.KEY))


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), ROWS)


def logged(spark, path, *pairs):
    log = ChangeLog(spark, str(path), ROWS)
    log.commit(frame(spark, *pairs), cdc.INSERT)
    return log


@pytest.mark.parametrize("kind", ["sink", "log"])
def test_two_checkpoints_write_into_one_target(spark, tmp_path, kind):
    make = BatchSink if kind == "sink" else ChangeLog
    target = make(spark, str(tmp_path / "target"), ROWS)
    for n in range(2):
        (tmp_path / f"drop{n}").mkdir()
        (tmp_path / f"drop{n}" / "a.csv").write_text(f"{n},1\n{n + 10},2\n")
        stream = csv_stream(spark, Source(str(tmp_path / f"drop{n}"), CsvFormat()), ROWS)
        for _ in range(2):  # the second run finds nothing new
            ingest_stream("load", stream, target, str(tmp_path / f"checkpoint{n}")).run()
    assert sorted(r["id"] for r in target.read().collect()) == [0, 1, 10, 11]


def test_folds_of_two_checkpoints_are_both_taken(spark, tmp_path, schema):
    for n in range(2):
        log = logged(spark, tmp_path / f"log{n}", (n, 5), (7, 1))
        task = maintain_sums("sums", log.stream(), "id", "v", f"{schema}.sums", str(tmp_path / f"cp{n}"))
        task.run()
    found = {r["id"]: r["total"] for r in read_sums(tables.read_table(spark, f"{schema}.sums"), "id").collect()}
    assert found == {0: 5, 1: 5, 7: 2}


def test_unfinished_commits_are_never_seen(spark, tmp_path, monkeypatch):
    log = logged(spark, tmp_path / "log", (1, 1))
    sink = BatchSink(spark, str(tmp_path / "sink"), ROWS)
    sink.append(frame(spark, (1, 1)), "first")

    def broken(*_):
        raise OSError("the writer dies before the rename")

    with monkeypatch.context() as m:
        m.setattr("ledgerline.streaming.changelog._on", broken)
        with pytest.raises(OSError):
            publish(frame(spark, (2, 2)), log.path, f"{log.path}/seq=1/writer=w")
        with pytest.raises(OSError):
            publish(frame(spark, (2, 2)), sink.path, f"{sink.path}/_batch=second")
    assert log.read().count() == 1 and log.position() == 0 and sink.read().count() == 1
    target = BatchSink(spark, str(tmp_path / "target"), ROWS)
    task = load_task("t", log.stream(), target, str(tmp_path / "cp"))
    task.run()
    log.commit(frame(spark, (2, 2)), cdc.INSERT, writer="w")
    log.commit(frame(spark, (2, 2)), cdc.INSERT, writer="w")
    task.run()
    assert sorted(r["id"] for r in target.read().collect()) == [1, 2]


def test_changes_of_one_key_in_one_commit_apply_in_order(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"), ROWS)
    steps = [(1, 10, "INSERT", 0), (1, 11, "UPDATE", 1), (1, 11, "DELETE", 2), (2, 5, "INSERT", 3), (2, 6, "UPDATE", 4)]
    for order in (steps, steps[::-1]):
        log.commit(spark.createDataFrame(order, "id long, v long, op string, row_no long").repartition(3))
        state = cdc.state_at(log.read(), "id").collect()
        assert [(r["id"], r["v"]) for r in state] == [(2, 6)]
    assert cdc.net_changes(log.read(), "id", since=0).count() == 0


def test_updates_are_split_or_refused(spark):
    log = spark.createDataFrame(
        [(1, 10, "INSERT", 1), (1, 15, "UPDATE", 2), (2, 7, "INSERT", 3), (2, 7, "DELETE", 4), (3, 1, "DELETE", 5), (4, None, "INSERT", 6)],
        "id long, v long, op string, seq long",
    )
    with pytest.raises(Exception, match="no old image"):
        partial_sums(log, "id", "v").collect()
    with pytest.raises(Exception, match="no old image"):
        cdc.net_row_changes(log, since=0).collect()
    split = cdc.split_updates(log, "id")
    sums = partial_sums(split, "id", "v").where("row_count <> 0")
    assert {r["id"]: r["total"] for r in read_sums(sums, "id").collect()} == {1: 15, 4: None}
    net = cdc.net_row_changes(split, since=1).collect()
    assert {(r["id"], r["v"], r["action"], r["row_count"]) for r in net} == {(1, 10, "DELETE", 1), (1, 15, "INSERT", 1), (4, None, "INSERT", 1)}


def brute_split(rows):
    """Every change of a key in order, an update as the row before and the new one."""
    out, present = [], {}
    for key, value, op, seq, row_no in sorted(rows, key=lambda r: (r[3], r[4])):
        if key in present:
            out.append((key, present.pop(key), "DELETE", seq, row_no))
        if op != "DELETE":
            present[key] = value
            out.append((key, value, "INSERT", seq, row_no))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_split_updates_over_many_ranges(spark, ranges):
    """A key with half of all changes lies in many ranges; nulls are a key and a value like others."""
    rnd = random.Random(ranges)
    rows = []
    for i in range(400):
        key = 7 if rnd.random() < 0.5 else rnd.choice([None, *range(60)])
        rows.append((key, rnd.choice([None, i]), rnd.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), i // 5, i))
    log = spark.createDataFrame(rows, "id long, v long, op string, seq long, row_no long").repartition(5)
    split = cdc.split_updates(log, "id", ranges)
    assert split.columns == log.columns
    assert sorted((tuple(r) for r in split.collect()), key=repr) == brute_split(rows)
    assert cdc.split_updates(log.limit(0), "id", ranges).count() == 0


def test_a_file_is_that_file_alone(spark, tmp_path):
    for name, key in (("crop.csv", 1), ("crop.csv.old", 2), ("a[1]*.csv", 3), ("a1x.csv", 4)):
        (tmp_path / name).write_text(f"{key},1\n")
    source = Source(str(tmp_path), CsvFormat())

    def ids(**which):
        return sorted(r["id"] for r in load_csv(spark, source, ROWS, **which).rows.collect())

    assert ids(file="crop.csv") == [1]
    assert ids(prefix="crop.csv") == [1, 2]
    assert ids(file="a[1]*.csv") == [3]
    assert ids(prefix="a[1]") == [3]
    with pytest.raises(ValueError):
        ids(file="a", prefix="a")


def test_bound_masks_hold_for_every_reader(spark, schema):
    name = f"{schema}.people"
    tables.materialize(spark.createDataFrame([(1, "a@x"), (2, "b@x")], "id long, email string"), name)
    with pytest.raises(ValueError):
        tables.bind_masks(spark, name, {"phone": EMAIL_MASK})
    tables.bind_masks(spark, name, {"email": EMAIL_MASK})
    assert {r["email"] for r in tables.read_table(spark, name).collect()} == {"*****"}
    assert {r["email"] for r in tables.read_table(spark, name, role="ANALYST").collect()} == {"*****"}
    assert {r["email"] for r in tables.read_table(spark, name, role=UNMASKED_ROLE).collect()} == {"a@x", "b@x"}
    # Maintenance works on the stored rows, and the masks stay.
    tables.delete_where(spark, name, F.col("email") == "a@x")
    assert [r["email"] for r in tables.read_table(spark, name, role=UNMASKED_ROLE).collect()] == ["b@x"]
    assert [r["email"] for r in tables.read_table(spark, name).collect()] == ["*****"]


def test_rejected_rows_show_in_the_run_log(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "a.csv").write_text("1,1\nx,2\ny,3\n")
    runs = RunLog(spark, str(tmp_path / "runs"))
    target = BatchSink(spark, str(tmp_path / "target"), ROWS)
    stream = csv_stream(spark, Source(str(tmp_path / "drop"), CsvFormat()), ROWS)
    ingest_stream("load", stream, target, str(tmp_path / "cp"), run_log=runs).run()
    run = runs.history("load").first()
    assert run["state"] == "SUCCEEDED" and run["error_message"].startswith("2 rows rejected, not kept")


def test_old_versions_go_and_the_present_one_stays(spark, schema):
    name, other = f"{schema}.t", f"{schema}.t_2"
    for table in (name, other):
        tables.materialize(frame(spark, (1, 1), (2, 2), (3, 3)), table)
        for key in (1, 2):
            tables.delete_where(spark, table, F.col("id") == key)
    assert tables.drop_old_versions(spark, name, dt.timedelta(days=1)) == 0
    assert tables.drop_old_versions(spark, name, dt.timedelta(0)) == 2
    assert tables.drop_old_versions(spark, name, dt.timedelta(0)) == 0
    for table in (name, other):
        assert [r["id"] for r in tables.read_table(spark, table).collect()] == [3]
    assert tables.drop_old_versions(spark, other, dt.timedelta(0)) == 2


def test_a_past_state_from_a_snapshot(spark):
    noon = dt.datetime(2026, 1, 1, 12)
    steps = [(1, 1, "INSERT"), (2, 2, "INSERT"), (1, 5, "UPDATE"), (2, 2, "DELETE"), (3, 3, "INSERT"), (1, 9, "UPDATE")]
    log = spark.createDataFrame(
        [(*s, n, noon + dt.timedelta(minutes=n)) for n, s in enumerate(steps)],
        "id long, v long, op string, seq long, commit_ts timestamp",
    )
    for at in range(6):
        ts = noon + dt.timedelta(minutes=at)
        whole = sorted(tuple(r) for r in cdc.as_of(log, "id", ts).collect())
        for since in range(at + 1):
            base = cdc.state_at(log, "id", since)
            assert sorted(tuple(r) for r in cdc.as_of(log, "id", ts, base=base, since=since).collect()) == whole
