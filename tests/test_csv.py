import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import VarcharType

from ledgerline import schemas
from ledgerline.schemas import table
from ledgerline.sources.csv_files import (
    ABORT,
    CONTINUE,
    CsvFormat,
    LoadHistory,
    Source,
    copy_into,
    list_files,
    load_csv,
)
from ledgerline.sources.tables import create_table

PLAIN = CsvFormat(header=True)
SCHEMA = table(id=schemas.KEY, name=schemas.TEXT, day=schemas.DATE)


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return Source(str(folder), PLAIN)


def test_clean_file_with_header(spark, tmp_path, rows):
    src = write(tmp_path / "in", "clean.csv", "id,name,day\n1,a,2025-01-02\n2,b,2025-03-04\n")
    loaded = load_csv(spark, src, SCHEMA, "clean.csv")
    assert rows(loaded.rows) == [(1, "a", dt.date(2025, 1, 2)), (2, "b", dt.date(2025, 3, 4))]
    assert loaded.rows.schema["id"].dataType == schemas.KEY


def test_no_header(spark, tmp_path, rows):
    write(tmp_path / "in", "no_header.csv", "1,a,2025-01-02\n")
    src = Source(str(tmp_path / "in"), CsvFormat())
    assert rows(load_csv(spark, src, SCHEMA).rows) == [(1, "a", dt.date(2025, 1, 2))]


BAD = "id,name,day\n1,a,2025-01-02\nx,b,2025-01-02\n3,short\n4,d,2025-01-02,long\n5,e,not a day\n"


def test_continue_keeps_good_rows_and_explains_the_rest(spark, tmp_path, rows):
    src = write(tmp_path / "in", "bad_rows.csv", BAD)
    loaded = load_csv(spark, src, SCHEMA, on_error=CONTINUE)
    assert rows(loaded.rows) == [(1, "a", dt.date(2025, 1, 2))]
    rejects = {r["_record"]: r["_reject_reason"] for r in loaded.rejects.collect()}
    assert rejects == {
        "x,b,2025-01-02": "id is not a bigint: x",
        "3,short": "wrong number of fields",
        "4,d,2025-01-02,long": "wrong number of fields",
        "5,e,not a day": "day is not a date: not a day",
    }
    assert loaded.rejects.where(F.col("_file").endswith("bad_rows.csv")).count() == 4


def test_counting_rows_does_not_hide_bad_ones(spark, tmp_path):
    src = write(tmp_path / "in", "bad_rows.csv", BAD)
    assert load_csv(spark, src, SCHEMA, on_error=CONTINUE).rows.count() == 1


def test_abort_loads_nothing(spark, tmp_path, schema):
    src = write(tmp_path / "in", "bad_rows.csv", BAD)
    create_table(spark, f"{schema}.t", SCHEMA)
    with pytest.raises(Exception, match="id is not a bigint: x|wrong number of fields|not a day"):
        copy_into(spark, src, SCHEMA, f"{schema}.t", on_error=ABORT)
    assert spark.table(f"{schema}.t").count() == 0


def test_unknown_error_mode(spark, tmp_path):
    src = write(tmp_path / "in", "clean.csv", "id,name,day\n")
    with pytest.raises(ValueError):
        load_csv(spark, src, SCHEMA, on_error="ignore")


def test_copy_into_counts_and_puts_rejects_aside(spark, tmp_path, schema):
    src = write(tmp_path / "in", "bad_rows.csv", BAD)
    create_table(spark, f"{schema}.t", SCHEMA)
    rejects = str(tmp_path / "rejects")
    result = copy_into(
        spark, src, SCHEMA, f"{schema}.t", on_error=CONTINUE, rejects_path=rejects
    )
    assert result == (1, 4)
    assert spark.table(f"{schema}.t").count() == 1
    assert spark.read.parquet(rejects).count() == 4


def test_quoted_fields(spark, tmp_path, rows):
    text = 'id,name,day\n1,"A, B",2025-01-02\n2,"say ""hi""",2025-01-02\n'
    write(tmp_path / "in", "quoted.csv", text)
    src = Source(str(tmp_path / "in"), CsvFormat(header=True, quote='"'))
    names = [r[1] for r in rows(load_csv(spark, src, SCHEMA).rows)]
    assert names == ["A, B", 'say "hi"']


def test_without_quote_character_quotes_are_text(spark, tmp_path, rows):
    src = write(tmp_path / "in", "f.csv", 'id,name,day\n1,"a",2025-01-02\n')
    assert rows(load_csv(spark, src, SCHEMA).rows)[0][1] == '"a"'


def test_both_null_tokens(spark, tmp_path, rows):
    write(tmp_path / "in", "nulls.csv", "id,name,day\n1,NULL,null\nnull,b,NULL\n3,Null,\n")
    fmt = CsvFormat(header=True, null_tokens=("NULL", "null"))
    loaded = load_csv(spark, Source(str(tmp_path / "in"), fmt), SCHEMA)
    assert rows(loaded.rows) == sorted([(1, None, None), (None, "b", None), (3, "Null", None)], key=repr)


def test_trim(spark, tmp_path, rows):
    write(tmp_path / "in", "spaces.csv", "id,name,day\n 1 ,  a b  , 2025-01-02 \n")
    for trim, name in ((True, "a b"), (False, "  a b  ")):
        src = Source(str(tmp_path / "in"), CsvFormat(header=True, trim=trim))
        assert rows(load_csv(spark, src, SCHEMA).rows) == [(1, name, dt.date(2025, 1, 2))]


def test_unscaled_numbers_round_unless_told_otherwise(spark, tmp_path, rows):
    soil = table(id=schemas.KEY, ph=schemas.NUMBER)
    src = write(tmp_path / "in", "fraction.csv", "id,ph\n1,6.5\n2,7.4\n3,-5.5\n4.5,5\n")
    declared = {r[0]: r[1] for r in load_csv(spark, src, soil).rows.collect()}
    assert declared == {1: Decimal(7), 2: Decimal(7), 3: Decimal(-6), 5: Decimal(5)}
    kept = {r[0]: r[1] for r in load_csv(spark, src, soil, numeric_scale=2).rows.collect()}
    assert kept[1] == Decimal("6.50") and kept[3] == Decimal("-5.50")


def test_too_long_text_and_too_large_number_are_bad(spark, tmp_path, rows):
    limited = table(id=schemas.MONEY, name=VarcharType(3))
    src = write(tmp_path / "in", "f.csv", "id,name\n1,abc\n2,abcd\n123456789.1,x\n")
    loaded = load_csv(spark, src, limited, on_error=CONTINUE)
    assert rows(loaded.rows) == [(Decimal("1.00"), "abc")]
    assert loaded.rejects.count() == 2


def test_prefix_and_whole_location(spark, tmp_path):
    folder = tmp_path / "farm data"
    src = write(folder, "orders_1.csv", "id,name,day\n1,a,2025-01-02\n")
    write(folder, "orders_2.csv", "id,name,day\n2,a,2025-01-02\n")
    write(folder / "orders", "part.csv", "id,name,day\n3,a,2025-01-02\n")
    write(folder, "stores.csv", "id,name,day\n4,a,2025-01-02\n")
    ids = lambda file: {r[0] for r in load_csv(spark, src, SCHEMA, prefix=file).rows.collect()}
    assert ids("orders") == {1, 2, 3}
    assert ids("orders_2.csv") == {2}
    assert ids(None) == {1, 2, 3, 4}


def test_list_files(spark, tmp_path):
    src = write(tmp_path / "in", "a.csv", "id\n")
    write(tmp_path / "in", "b.csv", "id,name\n")
    listed = {r["path"].rsplit("/", 1)[1]: r["length"] for r in list_files(spark, src).collect()}
    assert listed == {"a.csv": 3, "b.csv": 8}
    assert "content" not in list_files(spark, src).columns


def test_multiline(spark, tmp_path, rows):
    write(tmp_path / "in", "m.csv", 'id,name,day\n1,"two\nlines",2025-01-02\n')
    src = Source(str(tmp_path / "in"), CsvFormat(header=True, quote='"', multiline=True))
    assert rows(load_csv(spark, src, SCHEMA).rows)[0][1] == "two\nlines"


def test_history_passes_over_loaded_files(spark, tmp_path, schema):
    src = write(tmp_path / "in", "orders 1.csv", "id,name,day\n1,a,2025-01-02\n")
    name = f"{schema}.t"
    create_table(spark, name, SCHEMA)
    create_table(spark, f"{schema}.other", SCHEMA)
    history = LoadHistory(spark, str(tmp_path / "history"))

    def load(table=name):
        return copy_into(spark, src, SCHEMA, table, prefix="orders", history=history)

    assert load() == (1, 0)
    assert load() == (0, 0)
    assert load(f"{schema}.other") == (1, 0)
    write(tmp_path / "in", "orders 2.csv", "id,name,day\n2,a,2025-01-02\n3,a,2025-01-02\n")
    assert load() == (2, 0)
    assert LoadHistory(spark, str(tmp_path / "history")).loaded(name).count() == 2
    assert spark.table(name).count() == 3
