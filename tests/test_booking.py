from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripspark.operators import ordering
from tripspark.operators.booking import book, bookable_requests, booked_rows, invalid_requests, last_key, missing_requests
from tripspark.plans.bookings import read_bookings, run_bookings
from tripspark.sources.tables import load_table
from tripspark.schemas import BOOKING_REQUESTS

NOW = "TIMESTAMP_NTZ'2024-02-01 12:00:00'"
GOLDEN = [
    (1, "drive-now", 1, "booking success", "drivenow"),
    (2, "deutsche-bahn", 8, "booking success", "deutschebahn"),
    (3, "drive-now", 8, "route now found", None),
    (4, "drivenow", 1, "invalid_request", None),
    (5, None, 1, "invalid_request", None),
    (6, "drive-now", None, "invalid_request", None),
]


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame([g[:3] for g in GOLDEN], BOOKING_REQUESTS)


def test_golden(requests, routes):
    results = book(requests, routes, F.expr(NOW))
    assert rows(results, "request_id", "service", "route_id", "result", "service_provider") == GOLDEN
    booked = results.where("status = 'booked'")
    assert booked.where("booking_time IS NULL").count() == 0
    assert results.where("status <> 'booked' AND booking_time IS NOT NULL").count() == 0


def test_parts_add_up(requests, routes):
    parts = [bookable_requests(requests, routes), missing_requests(requests, routes), invalid_requests(requests)]
    assert [p.count() for p in parts] == [2, 1, 3]


def test_equal_routes_book_once(requests, routes):
    assert book(requests, routes.union(routes), F.expr(NOW)).count() == len(GOLDEN)
    assert bookable_requests(requests, routes.union(routes)).count() == 2


def test_request_sent_again_books_once(requests, routes):
    results = book(requests.union(requests), routes, F.expr(NOW))
    assert results.count() == len(GOLDEN)
    assert results.where("status = 'booked'").count() == 2


def test_requests_without_id_are_kept(spark, routes):
    asked = spark.createDataFrame([(None, "drive-now", 1), (None, "drive-now", 2), (None, "x", 1)], BOOKING_REQUESTS)
    assert sorted(r["status"] for r in book(asked, routes).collect()) == ["booked", "booked", "invalid"]


def test_text_ids(spark, routes):
    asked = spark.createDataFrame([(1, "drive-now", "1"), (2, "drive-now", "abc")], "request_id BIGINT, service STRING, route_id STRING")
    assert rows(book(asked, routes), "request_id", "status") == [(1, "booked"), (2, "invalid")]


def test_heavy_route(spark, routes, force_hot):
    asked = spark.createDataFrame(
        [(i, "drive-now", 1) for i in range(300)] + [(1000 + i, "drive-now", 100 + i) for i in range(100)]
        + [(2000 + i, None, None) for i in range(300)],
        BOOKING_REQUESTS,
    )
    counts = {r["status"]: r["count"] for r in book(asked, routes).groupBy("status").count().collect()}
    assert counts == {"booked": 300, "missing": 100, "invalid": 300}
    assert bookable_requests(asked, routes).count() == 300
    assert missing_requests(asked, routes).count() == 100


def test_one_time_per_query(requests, routes):
    times = {r[0] for r in book(requests, routes).select("booking_time").collect()} - {None}
    assert len(times) == 1 and times.pop().microsecond == 0


def test_run_appends_with_rising_keys(spark, requests, routes, tmp_path):
    path = str(tmp_path / "bookings")
    results = run_bookings(requests, routes, path, 0, F.expr(NOW))
    booked = [(1, "drivenow", 1), (2, "deutschebahn", 8)]
    assert rows(read_bookings(spark, path), "id", "service_provider", "route_id") == booked
    assert results.count() == len(GOLDEN)
    assert last_key(read_bookings(spark, path)) == 2
    assert run_bookings(requests, routes, path, 0, F.expr(NOW)).count() == len(GOLDEN)  # the run again
    assert run_bookings(requests.where("request_id IS NOT NULL"), routes, path, 1).count() == 0
    again = requests.withColumn("request_id", F.col("request_id") + 1000)
    run_bookings(again, routes, path, 2, F.expr(NOW))
    assert [r[0] for r in rows(read_bookings(spark, path), "id")] == [1, 2, 3, 4]
    shutil.copytree(f"{path}/booked", tmp_path / "booked_routes")
    assert load_table(spark, "booked_routes", str(tmp_path)).count() == 4


def test_no_bookings(spark, requests, routes):
    none = book(requests.where("request_id > 2"), routes)
    assert booked_rows(none).count() == 0
    assert last_key(booked_rows(none)) == 0


def test_rows_without_id_need_not_fit_in_one_range(spark, monkeypatch):
    staged = []

    def keep(df, name, plain=ordering.stage):
        staged.append(plain(df, name))
        return staged[-1]

    monkeypatch.setattr(ordering, "stage", keep)
    df = spark.range(4_000, numPartitions=4).select(F.lit(None).cast("long").alias("request_id"), F.lit(1).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join such small ranges
    try:
        keyed = ordering.with_dense_keys(df, ["request_id"], start=10)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["id"] for r in keyed.orderBy("id").collect()] == list(range(11, 4_011))
    parts = staged[-1].groupBy(F.shiftright("_place", 33)).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 3_000
