"""Booking of a table of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.operators.booking import book, booked_rows, last_key
from tripspark.operators.skew import lookup_join
from tripspark.schemas import BOOKED_ROUTES
from tripspark.sinks.tables import has_batches, read_batches, replace_batch


def run_bookings(
    requests: DataFrame, routes: DataFrame, path: str, run_id: int, now: Column | None = None
) -> DataFrame:
    """Answer every request that earlier runs have not answered, and return the results of this run.

    Results go to `path`/results and booked rows to `path`/booked, each in a folder of the run. A run again, after a
    crash or by mistake, replaces its own rows: it looks at runs with smaller numbers only, for what is answered and for
    the last key. Requests without id are answered in every run that brings them.
    """
    spark = requests.sparkSession
    results_path, booked_path = f"{path.rstrip('/')}/results", f"{path.rstrip('/')}/booked"
    new = requests
    if has_batches(spark, results_path):
        earlier = spark.read.schema("request_id BIGINT, batch_id INT").parquet(results_path).where(F.col("batch_id") < run_id)
        new = lookup_join(requests, earlier.select("request_id"), ["request_id"], "left_anti")
    replace_batch(book(new, routes, now), results_path, run_id)
    results = read_batches(spark, results_path).where(F.col("batch_id") == run_id).drop("batch_id")
    last = 0
    if has_batches(spark, booked_path):
        stored = spark.read.schema("id BIGINT, batch_id INT").parquet(booked_path)
        last = last_key(stored.where(F.col("batch_id") < run_id))
    replace_batch(booked_rows(results, last, stored=True), booked_path, run_id)
    return results


def read_bookings(spark: SparkSession, path: str) -> DataFrame:
    """The booked rows of all runs, with the columns of the table."""
    return spark.read.schema(BOOKED_ROUTES).parquet(f"{path.rstrip('/')}/booked").drop("batch_id")
