"""Every registered query against its SQL twin over whole tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from tests.compare import differences, duck_connection
from tests.conftest import DATA
from tripspark.queries import QUERIES, SQL

@pytest.fixture(scope="module")
def duck():
    return duck_connection(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, DATA), duck, SQL[name]) == ""


def test_entry_has_rows(spark):
    result = entry(spark)
    assert result.columns == ["origin", "destination", "requests", "status", "distance", "page", "routes"]
    assert result.limit(1).count() == 1
