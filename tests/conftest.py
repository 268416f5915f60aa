import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import local_session  # noqa: E402
from ledgerline.sources.tables import create_layers  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        partitions=4,
        **{
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.checkpoint.dir": str(work / "shared"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s_{tmp_path.name}".replace("-", "_").replace("[", "_").replace("]", "_").lower()
    create_layers(spark, name, base=str(tmp_path / "layers"))
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


@pytest.fixture
def duck():
    """Runs SQL on DuckDB over DataFrames passed by name; gives sorted rows."""

    def run(sql, **frames):
        con = duckdb.connect()
        for name, df in frames.items():
            con.register(name, df.toArrow())
        return sorted(con.sql(sql).fetchall(), key=repr)

    return run


@pytest.fixture
def rows():
    def run(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return run
