"""Booking requests against the stored routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.functions.times import now_seconds
from tripspark.operators.ordering import with_dense_keys
from tripspark.operators.skew import lookup_join
from tripspark.vocabulary import BOOKED_TEXT, INVALID_TEXT, MISSING_TEXT, PROVIDERS

RESULT_COLUMNS = ["request_id", "service", "route_id", "status", "result", "service_provider", "booking_time"]


def known_provider(service: Column) -> Column:
    """False also for NULL."""
    return F.coalesce(service.isin(*PROVIDERS), F.lit(False))


def stored_name(service: Column) -> Column:
    names = F.create_map(*[F.lit(v) for pair in PROVIDERS.items() for v in pair])
    return F.try_element_at(names, service)


def with_number(requests: DataFrame) -> DataFrame:
    """Route ids as numbers; other text becomes NULL."""
    return requests.withColumn("route_id", F.col("route_id").try_cast("bigint"))


def one_per_request(requests: DataFrame) -> DataFrame:
    """A request sent again has the same id and is answered once; of differing copies the smallest counts.

    Requests without id are all kept.
    """
    asked = with_number(requests).select("request_id", "service", "route_id")
    once = (
        asked.where(F.col("request_id").isNotNull())
        .groupBy("request_id")
        .agg(F.min(F.struct("service", "route_id")).alias("_ask"))
        .select("request_id", "_ask.service", "_ask.route_id")
    )
    return once.unionByName(asked.where(F.col("request_id").isNull()))


def route_keys(routes: DataFrame) -> DataFrame:
    """Keys of bookable routes, named as in requests."""
    return routes.select(
        F.col("service_provider").alias("service"), F.col("route_id").cast("bigint").alias("route_id")
    )


def valid_requests(requests: DataFrame) -> DataFrame:
    return with_number(requests).where(known_provider(F.col("service")) & F.col("route_id").isNotNull())


def invalid_requests(requests: DataFrame) -> DataFrame:
    return with_number(requests).where(~known_provider(F.col("service")) | F.col("route_id").isNull())


def bookable_requests(requests: DataFrame, routes: DataFrame) -> DataFrame:
    """Valid requests for a route that exists; equal routes do not repeat a request."""
    return lookup_join(valid_requests(requests), route_keys(routes), ["service", "route_id"], "left_semi")


def missing_requests(requests: DataFrame, routes: DataFrame) -> DataFrame:
    """Valid requests for a route that does not exist."""
    return lookup_join(valid_requests(requests), route_keys(routes), ["service", "route_id"], "left_anti")


def outcome(found: DataFrame, now: Column | None = None) -> DataFrame:
    """Status, result text and booked values from `_found`."""
    valid = known_provider(F.col("service")) & F.col("route_id").isNotNull()
    booked = valid & F.col("_found").isNotNull()
    return found.select(
        "request_id",
        "service",
        "route_id",
        F.when(booked, "booked").when(valid, "missing").otherwise("invalid").alias("status"),
        F.when(booked, BOOKED_TEXT).when(valid, MISSING_TEXT).otherwise(INVALID_TEXT).alias("result"),
        F.when(booked, stored_name(F.col("service"))).alias("service_provider"),
        F.when(booked, now_seconds() if now is None else now).alias("booking_time"),
    )


def book(requests: DataFrame, routes: DataFrame, now: Column | None = None) -> DataFrame:
    """One result per request id: booked, missing (no such route) or invalid."""
    keys = route_keys(routes).distinct().withColumn("_found", F.lit(True))
    found = lookup_join(
        one_per_request(requests), keys, ["service", "route_id"], "left", keys_from=with_number(requests)
    )
    return outcome(found, now)


def booked_rows(results: DataFrame, last_id: int = 0, stored: bool = False) -> DataFrame:
    """Rows to append to the stored bookings, with keys that go on after `last_id`; `stored` tells that results are a table."""
    booked = results.where(F.col("status") == "booked").select(
        "request_id", "service_provider", "route_id", "booking_time"
    )
    return with_dense_keys(booked, ["request_id", "service_provider", "route_id"], "id", last_id, stored).drop("request_id")


def last_key(stored: DataFrame, column: str = "id") -> int:
    return stored.agg(F.max(column).alias("last")).first()["last"] or 0
