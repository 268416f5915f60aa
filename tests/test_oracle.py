"""Every registered query against its SQL on DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from ledgerline.plans import registry
from tools.check_oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_only_the_sample_has_no_sql():
    assert set(registry.queries()) - set(ORACLE) == {"limit_sample"}


def test_sample_gives_rows_of_the_table(spark):
    sample = QUERIES["limit_sample"](spark, SF_DIR)
    facts = QUERIES["fact_sales"](spark, SF_DIR).drop("customer_id")
    assert sample.count() == 10
    assert sample.join(facts, sample.columns, "left_anti").count() == 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
