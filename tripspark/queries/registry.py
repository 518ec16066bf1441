"""Collects the registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tripspark.queries.views import with_views
from tripspark.session import use_utc
from tripspark.sources.analog import AnalogTables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable[[AnalogTables], DataFrame]], Callable[[AnalogTables], DataFrame]]:
    """Register a function of the derived tables under its own name. `sql` gives the same rows."""

    def register(function: Callable[[AnalogTables], DataFrame]) -> Callable[[AnalogTables], DataFrame]:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(AnalogTables(use_utc(spark), folder))

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = with_views(sql)
        return function

    return register
