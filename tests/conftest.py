from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession

from tripspark.session import use_utc
from tripspark.sources.analog import AnalogTables
from tripspark.sources.seed import seed_routes, seed_table
from tripspark.operators.routes import provider_union

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tripspark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield use_utc(session)
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return AnalogTables(spark, DATA)


@pytest.fixture(scope="session")
def cities(spark):
    return seed_table(spark, "cities")


@pytest.fixture(scope="session")
def routes(spark):
    return provider_union(seed_routes(spark))


@pytest.fixture
def force_hot(monkeypatch):
    """Treat a key as heavy when it holds over a tenth of the rows, however few those are."""
    monkeypatch.setattr("tripspark.operators.skew.HOT_ROWS", 2)
    monkeypatch.setattr("tripspark.operators.skew.HOT_PARTITIONS", 0.4)  # of 4 partitions
    monkeypatch.setattr("tripspark.operators.skew.SMALL_ROWS", 0)


def rows(df, *columns):
    """Sorted tuples, NULL first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda t: [(v is not None, str(v)) if not isinstance(v, (int, float)) else (True, f"{v:030.6f}") for v in t])
