"""Bucketed tables: folds that rewrite only what they touch, and go on where they were interrupted."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import changes as cdc
from ledgerline.operators.stored_sums import read_sums
from ledgerline.sources import buckets, tables
from ledgerline.streaming.changelog import ChangeLog
from ledgerline.streaming.refresh import apply_task, maintain_sums, refresh_sums

SCHEMA = schemas.table(id=schemas.KEY, v=schemas.KEY)
FRAME = "id long, v long"


def files(spark, name):
    """Data files of a table by bucket."""
    place = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    found = {}
    for path in glob.glob(f"{place.removeprefix('file:')}/{buckets.BUCKET}=*/*.parquet"):
        found.setdefault(int(path.split(f"{buckets.BUCKET}=")[1].split("/")[0]), set()).add(os.path.basename(path))
    return found


def changed(before, after):
    return {b for b in before.keys() | after.keys() if before.get(b) != after.get(b)}


@pytest.fixture
def filled(spark, schema):
    name = f"{schema}.t"
    tables.materialize_in_buckets(spark.range(2000).select("id", (F.col("id") * 2).alias("v")), name, ["id"], 16)
    return name


def numbers(spark, name, ids):
    return set(buckets.touched_buckets(spark.createDataFrame([(i,) for i in ids], "id long"), buckets.layout(spark, name)))


def test_a_fold_rewrites_only_touched_buckets(spark, filled):
    before = files(spark, filled)
    assert set(before) == set(range(16))
    delta = spark.createDataFrame([(1, 0), (5, 0)], FRAME)
    done = tables.fold_table(spark, filled, delta, lambda rows: rows.withColumn("v", F.when(F.col("id").isin(1, 5), 0).otherwise(F.col("v"))), "a")
    assert set(done) == numbers(spark, filled, [1, 5]) == changed(before, files(spark, filled))
    assert tables.stored_rows(spark, filled).where("v = 0").count() == 3
    assert tables.stored_rows(spark, filled).count() == 2000


def test_a_fold_of_no_keys_touches_nothing_and_is_told(spark, filled):
    before = files(spark, filled)
    none = spark.createDataFrame([], FRAME)
    assert tables.fold_table(spark, filled, none, lambda rows: rows.unionByName(none), "none") == []
    assert files(spark, filled) == before and buckets.layout(spark, filled).label == "none"


def test_only_touched_files_are_read(spark, filled):
    plan = buckets.in_buckets(spark, filled, [3])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({buckets.BUCKET}" in plan and f"{buckets.BUCKET}#" in plan
    assert buckets.in_buckets(spark, filled, []).count() == 0


def test_emptied_buckets_have_no_files(spark, filled, rows):
    tables.delete_where(spark, filled, F.col("id") >= 2)
    assert rows(tables.stored_rows(spark, filled)) == [(0, 0), (1, 2)]
    assert set(files(spark, filled)) == numbers(spark, filled, [0, 1])


def test_delete_touches_only_buckets_with_such_rows(spark, filled, tmp_path):
    before = files(spark, filled)
    log = ChangeLog(spark, str(tmp_path / "log"), tables.stored_rows(spark, filled).schema)
    tables.delete_where(spark, filled, F.col("v") == 84, log)
    assert changed(before, files(spark, filled)) == numbers(spark, filled, [42])
    assert [tuple(r) for r in log.read().select("id", "op").collect()] == [(42, "DELETE")]
    assert tables.stored_rows(spark, filled).count() == 1999


@pytest.mark.parametrize("broken", ["insertInto", "_drop_bucket"])
def test_an_interrupted_fold_goes_on_from_its_own_rows(spark, filled, monkeypatch, broken):
    """The overwrite fails half way: some buckets are gone, and the retry still gives the right table."""
    from pyspark.sql.readwriter import DataFrameWriter

    add = lambda rows: rows.withColumn("v", F.col("v") + 1)
    drop = lambda rows: rows.where("id >= 40 AND id < 41")
    step = add if broken == "insertInto" else drop
    wanted = sorted(2 * i + 1 for i in range(2000)) if broken == "insertInto" else None

    def fail(*args, **kwargs):
        buckets._forget(spark, f"{place}/{buckets.BUCKET}=3")
        raise OSError("lost")

    place = spark.sql(f"DESCRIBE FORMATTED {filled}").where("col_name = 'Location'").first()["data_type"]
    with monkeypatch.context() as patched, pytest.raises(OSError, match="lost"):
        patched.setattr(*((DataFrameWriter, broken) if broken == "insertInto" else (buckets, broken)), fail)
        tables.fold_table(spark, filled, None, step, "x")
    for _ in range(2):  # the retry, and one more that finds everything done
        assert set(tables.fold_table(spark, filled, None, step, "x")) == set(range(16))
    found = sorted(r.v for r in tables.stored_rows(spark, filled).collect())
    assert found == (wanted or [80])


def test_keys_are_hashed_in_the_types_of_the_table(spark, filled):
    as_text = spark.createDataFrame([("7", "1")], "id string, v string")
    how = buckets.layout(spark, filled)
    assert set(buckets.touched_buckets(as_text, how)) == numbers(spark, filled, [7])
    tables.fold_table(spark, filled, as_text, lambda rows: rows.where("id <> 7").unionByName(as_text), "t")
    assert [r.v for r in tables.stored_rows(spark, filled).where("id = 7").collect()] == [1]


def test_applied_changes_rewrite_the_buckets_of_changed_keys(spark, tmp_path, schema, rows):
    log = ChangeLog(spark, str(tmp_path / "log"), SCHEMA)
    name = f"{schema}.t"
    tables.create_in_buckets(spark, name, schemas.frame_schema(SCHEMA), ["id"], 16)
    log.commit(spark.range(500).select("id", F.col("id").alias("v")), cdc.INSERT)
    apply_task("apply", log.stream(), "id", name, str(tmp_path / "cp")).run()
    before = files(spark, name)
    log.commit(spark.createDataFrame([(3, 30), (900, 9)], FRAME), cdc.UPDATE)
    log.commit(spark.createDataFrame([(4, 4)], FRAME), cdc.DELETE)
    apply_task("apply", log.stream(), "id", name, str(tmp_path / "cp")).run()
    as_key = spark.createDataFrame([(i,) for i in (3, 4, 900)], "id long")
    assert changed(before, files(spark, name)) == set(buckets.touched_buckets(as_key, buckets.layout(spark, name)))
    assert rows(tables.read_table(spark, name)) == rows(cdc.state_at(log.read(), "id"))
    with pytest.raises(Exception, match="not by the key"):
        apply_task("other", log.stream(), "v", name, str(tmp_path / "cp2")).run()


def test_maintained_sums_rewrite_the_buckets_of_changed_keys(spark, tmp_path, schema, rows):
    log = ChangeLog(spark, str(tmp_path / "log"), SCHEMA)
    name = f"{schema}.sums"
    log.commit(spark.range(300).select("id", F.col("id").alias("v")), cdc.INSERT)
    maintain_sums("sums", log.stream(), "id", "v", name, str(tmp_path / "cp")).run()
    before = files(spark, name)
    log.commit(spark.createDataFrame([(7, 70)], FRAME), cdc.INSERT)
    maintain_sums("sums", log.stream(), "id", "v", name, str(tmp_path / "cp")).run()
    assert len(changed(before, files(spark, name))) == 1
    sums = {r.id: r.total for r in read_sums(tables.read_table(spark, name), "id").collect()}
    assert sums == {i: i + 70 * (i == 7) for i in range(300)}


def test_a_batch_that_changes_ten_keys_hands_on_ten(spark, tmp_path, schema):
    log = ChangeLog(spark, str(tmp_path / "log"), SCHEMA)
    name, handed = f"{schema}.sums", []

    def run():
        task = refresh_sums("sums", log.stream(), ["id"], [F.sum("v").alias("total")], name, str(tmp_path / "cp"))
        work = task.work
        task.work = lambda batch, label: (handed.append(batch.count()), work(batch, label))[1]
        task.run()

    log.commit(spark.range(2000).select("id", F.lit(1).alias("v")), cdc.INSERT)
    run()
    before = files(spark, name)
    log.commit(spark.range(10).select("id", F.lit(5).alias("v")), cdc.INSERT)
    run()
    assert handed == [2000, 10]
    assert 0 < len(changed(before, files(spark, name))) <= 10
    found = {r.id: r.total for r in tables.read_table(spark, name).collect()}
    assert found == {i: 6 if i < 10 else 1 for i in range(2000)}


def test_tables_without_buckets_are_told_apart(spark, schema):
    tables.materialize(spark.range(3), f"{schema}.plain")
    assert buckets.layout(spark, f"{schema}.plain") is None
    with pytest.raises(ValueError, match="not bucketed"):
        tables.fold_table(spark, f"{schema}.plain", None, lambda rows: rows, "x")
    with pytest.raises(ValueError, match="no columns"):
        tables.create_in_buckets(spark, f"{schema}.b", spark.range(1).schema, ["nope"])
