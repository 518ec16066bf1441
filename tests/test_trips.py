from __future__ import annotations

import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tripspark.functions.geo import haversine_km, two_decimals
from tripspark.functions.text import booking_link, distance_body, distance_label, parse_distance
from tripspark.functions.times import day_of_time, time_text
from tripspark.operators.cities import cities_by_id, city_list, city_pair_distance, connected_distances, requested_cities
from tripspark.operators.routes import (
    numbered_routes, provider_union, requests_with_routes, route_pages, routes_by_id, routes_by_pair, routes_for_pair,
)
from tripspark.plans.trips import request_answers, trip_rows, trip_search, with_request
from tripspark.schemas import TRIP_REQUESTS
from tripspark.sinks.json_out import trip_bodies, write_json
from tripspark.sources.seed import seed_routes, seed_table
from tripspark.sources.tables import JdbcSource, load_table, lookup
from tripspark.sources.seed import load_seed

KM = {(1, 2): 304.58511830645733, (1, 3): 504.4153314003782, (2, 3): 423.52802493804637}

# (origin, destination) -> status, distance, ids of car routes, ids of rail routes
GOLDEN = {
    (1, 2): ("ok", 304.59, [1, 2], []),
    (1, 3): ("ok", 504.42, [3], [5]),
    (2, 3): ("ok", 423.53, [4], []),
    (2, 1): ("ok", 304.59, [], [2, 4]),
    (3, 1): ("ok", 504.42, [], [3, 6, 8]),
    (3, 2): ("ok", 423.53, [], [1, 7]),
    (1, 1): ("error", None, [], []),
    (1, 9): ("error", None, [], []),
}


@pytest.fixture(scope="module")
def requests(spark):
    """Every golden pair, (1, 3) three times, and requests without a city."""
    asked = [*GOLDEN, (1, 3), (1, 3), (None, 2), (0, 1)]
    return spark.createDataFrame([(i, *pair) for i, pair in enumerate(asked)], TRIP_REQUESTS)


def test_seed_counts(spark):
    counts = {n: seed_table(spark, n).count() for n in ("cities", "deutschebahn_routes", "drivenow_routes")}
    assert counts == {"cities": 3, "deutschebahn_routes": 8, "drivenow_routes": 4}


def test_tables_by_name(spark, tmp_path):
    load_seed(spark, str(tmp_path))
    stored = load_table(spark, "deutschebahn_routes", str(tmp_path))
    assert stored.schema.fieldNames() == ["route_id", "origin", "destination", "traveldate", "partner", "cost"]
    found = lookup(stored, origin=3, destination=2)
    assert rows(found, "route_id") == [(1,), (7,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(origin,3)" in plan and "EqualTo(destination,2)" in plan


def test_database_reads_are_split():
    source = JdbcSource("jdbc:mysql://host/db", ("route_id", 1, 1000, 16))
    assert source.options("routes")["numPartitions"] == 16
    assert source.options("routes")["table"] == "routes"


def test_city_lookups(cities, requests):
    assert rows(city_list(cities), "city_name") == [("Berlin",), ("Frankfurt",), ("Munich",)]
    assert rows(cities_by_id(cities, 1, 3), "city_id") == [(1,), (3,)]
    assert rows(requested_cities(requests, cities), "city_id") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("pair", list(KM))
def test_distance(spark, cities, pair):
    for origin, destination in (pair, pair[::-1]):
        asked = spark.createDataFrame([(1, origin, destination)], TRIP_REQUESTS)
        answer = city_pair_distance(asked, cities).first()
        assert answer["km"] == pytest.approx(KM[pair], rel=1e-12)
        assert answer["distance"] == round(KM[pair], 2)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.floats(-90, 90), st.floats(-180, 180)] * 2), min_size=1, max_size=20))
def test_distance_properties(spark, points):
    df = spark.createDataFrame(points, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    there, back = haversine_km(*[F.col(c) for c in "abcd"]), haversine_km(*[F.col(c) for c in "cdab"])
    same = haversine_km(*[F.col(c) for c in "abab"])
    for km, reverse, none in df.select(there, back, same).collect():
        assert km == pytest.approx(reverse, abs=1e-6)
        assert none == 0
        assert 0 <= km <= math.pi * 6371 + 1e-6


def test_two_decimals(spark):
    df = spark.createDataFrame([(0.125,), (1.005,), (2.675,), (None,)], "km DOUBLE")
    assert [r[0] for r in df.select(two_decimals(F.col("km"))).take(3)] == ["0.13", "1.01", "2.68"]
    bodies = [r[0] for r in df.select(distance_body(F.col("km"))).collect()]
    assert bodies[0] == '{"result": 0.13}' and json.loads(bodies[3]) == {"error": "City not found in database"}


def test_parse_distance(spark):
    texts = ['{"result": 304.59}', '{"error" : "City not found in database"}', "broken", "{}", None]
    df = spark.createDataFrame([(t,) for t in texts], "body STRING")
    assert [r[0] for r in df.select(parse_distance(F.col("body"))).collect()] == [304.59, None, None, None, None]


def test_texts(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2017-01-02 07:00:00' AS t, 304.59D AS d, CAST(NULL AS STRING) AS none")
    row = df.select(
        time_text(F.col("t")), day_of_time(F.col("t")).cast("string"), distance_label(F.col("d")),
        booking_link(F.lit("drive-now"), F.lit(3)), booking_link(F.col("none"), F.lit(3)),
    ).first()
    assert tuple(row) == (
        "2017-01-02T07:00:00UTC", "2017-01-02", "304.59 Km", "/accounting-core-service/drive-now/3/book", None
    )


def test_connected_distances(spark, cities):
    pairs = spark.createDataFrame([(1, 2), (2, 1), (1, 2), (3, 3), (2, 9), (None, 1)], "origin INT, destination INT")
    assert [(r["city_a"], r["city_b"]) for r in connected_distances(pairs, cities).collect()] == [(1, 2)]


def test_route_lookups(spark, routes, requests):
    assert rows(routes_for_pair(routes, 1, 3), "service_provider", "route_id") == [("deutsche-bahn", 5), ("drive-now", 3)]
    assert rows(routes_by_id(routes, "drive-now", 4), "partner") == [("Arnold",)]
    assert routes_by_id(routes, "drive-now", 8).count() == 0
    assert routes_by_pair(requests, routes).count() == 12
    only = spark.createDataFrame([(1, 1, 2), (2, 1, 2)], TRIP_REQUESTS)
    assert routes_by_pair(only, routes).count() == 2
    flat = requests_with_routes(requests, routes)
    assert flat.where("request_id = 1").count() == 2 and flat.where("request_id = 6").count() == 1


def test_union_keeps_duplicates_and_order(spark):
    car = seed_table(spark, "drivenow_routes")
    twice = provider_union({"drive-now": car.union(car), "deutsche-bahn": seed_routes(spark)["deutsche-bahn"]})
    assert twice.count() == 16
    assert set(rows(twice, "service_provider", "provider_rank")) == {("drive-now", 0), ("deutsche-bahn", 1)}


def _answers(df):
    return {(r["origin"], r["destination"]): r for r in df.collect()}


def test_trip_search_golden(requests, cities, routes):
    answers = _answers(trip_search(requests, cities, routes))
    for pair, (status, distance, car, rail) in GOLDEN.items():
        answer = answers[pair]
        assert (answer["status"], answer["distance"], answer["page"]) == (status, distance, 0)
        expected = [("drive-now", i) for i in car] + [("deutsche-bahn", i) for i in rail]
        assert [(r["service_provider"], r["route_id"]) for r in answer["routes"]] == expected
    assert answers[(1, 3)]["requests"] == 3
    assert answers[(None, 2)]["status"] == "error" and answers[(0, 1)]["status"] == "error"


def test_trip_search_pages_hold_the_whole_list(requests, cities, routes):
    pages = [r for r in trip_search(requests, cities, routes, page_size=2).collect() if (r.origin, r.destination) == (3, 1)]
    assert [[r["route_id"] for r in p["routes"]] for p in sorted(pages, key=lambda p: p["page"])] == [[3, 6], [8]]


def test_trip_search_with_heavy_pairs(requests, cities, routes, force_hot):
    test_trip_search_golden(requests, cities, routes)


def test_answers_of_requests(requests, cities, routes):
    answers = with_request(requests, trip_search(requests, cities, routes))
    by_request = {r["request_id"]: r for r in answers.collect()}
    assert len(by_request) == requests.count()
    assert by_request[1]["routes"] == by_request[8]["routes"] == by_request[9]["routes"]
    lengths = {r["request_id"]: r["route_count"] for r in request_answers(requests, cities, routes).collect()}
    assert lengths == {k: len(r["routes"]) for k, r in by_request.items()}


def test_request_answers_with_heavy_pairs(requests, cities, routes, force_hot):
    test_answers_of_requests(requests, cities, routes)


def test_trip_rows(requests, cities, routes):
    found = trip_rows(requests, cities, routes).where("origin = 1 AND destination = 3").orderBy("row_no").collect()
    assert [(r["row_no"], r["service_provider"], r["route_id"]) for r in found] == [(0, "drive-now", 3), (1, "deutsche-bahn", 5)]
    assert found[0]["link"] == "/accounting-core-service/drive-now/3/book"
    assert found[0]["date_text"] == "2017-02-03T12:00:00UTC"


def test_trip_body(requests, cities, routes):
    bodies = {(r["origin"], r["destination"]): json.loads(r["body"]) for r in trip_bodies(trip_search(requests, cities, routes)).collect()}
    assert bodies[(1, 9)] == {"distance": None, "routes": []}
    assert bodies[(2, 3)] == {
        "distance": 423.53,
        "routes": [
            {
                "routeId": 4, "origin": 2, "destination": 3, "date": "2017-02-03T00:00:00UTC", "partner": "Arnold",
                "cost": 45, "serviceProvider": "drive-now",
            }
        ],
    }


def test_json_output(spark, requests, cities, routes, tmp_path):
    path = str(tmp_path / "answers")
    write_json(trip_search(requests, cities, routes).where("origin = 2 AND destination = 3"), path)
    answer = json.loads(spark.read.text(path).first()[0])
    assert answer["distance"] == 423.53 and answer["routes"][0]["date"] == "2017-02-03"


def test_route_without_date(spark, cities):
    route = spark.createDataFrame(
        [(1, 1, 2, None, "X", 5, "drive-now")],
        "route_id INT, origin INT, destination INT, traveldate TIMESTAMP_NTZ, partner STRING, cost INT, service_provider STRING",
    )
    asked = spark.createDataFrame([(1, 1, 2)], TRIP_REQUESTS)
    assert trip_search(asked, cities, route).first()["routes"][0]["date"] is None


def test_route_pages_in_order(spark, routes):
    pages = route_pages(numbered_routes(routes), page_size=2).where("origin = 3 AND destination = 1").orderBy("page")
    assert [[r["route_id"] for r in p["routes"]] for p in pages.collect()] == [[3, 6], [8]]
