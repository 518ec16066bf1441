"""Cities, routes and trip search."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.functions.text import distance_body, distance_label, parse_distance
from tripspark.functions.times import day_of_time
from tripspark.operators import cities, routes
from tripspark.plans import trips
from tripspark.queries.registry import query
from tripspark.session import fresh_path
from tripspark.sinks.json_out import trip_bodies
from tripspark.sources.analog import AnalogTables
from tripspark.sources.pairroutes import PairRoutes
from tripspark.vocabulary import PROVIDERS

PAGE_SIZE = 50  # small enough that some lists have several pages


@query("SELECT city_id, city_name, latitude, longitude FROM v_cities")
def city_list(t: AnalogTables) -> DataFrame:
    return cities.city_list(t.cities())


@query("""
SELECT * FROM v_cities WHERE city_id IN
  (SELECT origin FROM v_trip_requests UNION SELECT destination FROM v_trip_requests)""")
def requested_cities(t: AnalogTables) -> DataFrame:
    return cities.requested_cities(t.trip_requests(), t.cities())


@query("""
SELECT request_id, origin, destination, ROUND(km, 4) AS km, distance, status,
       CAST(distance AS VARCHAR) || ' Km' AS label FROM v_trips""")
def city_pair_distance(t: AnalogTables) -> DataFrame:
    return cities.city_pair_distance(t.trip_requests(), t.cities()).withColumns(
        {"km": F.round("km", 4), "label": distance_label(F.col("distance"))}
    )


@query("""
SELECT request_id,
       CASE WHEN km IS NULL THEN '{"error" : "City not found in database"}'
            ELSE '{"result": ' || printf('%.2f', km) || '}' END AS body,
       distance FROM v_trips""")
def distance_json(t: AnalogTables) -> DataFrame:
    """Distance answers as JSON text, and the number read back from the text."""
    bodies = cities.city_pair_distance(t.trip_requests(), t.cities()).select(
        "request_id", distance_body(F.col("km")).alias("body")
    )
    return bodies.withColumn("distance", parse_distance(F.col("body")))


@query("""
SELECT origin AS city_a, destination AS city_b, ROUND(km, 4) AS km, ROUND(km, 2) AS distance
FROM v_distances WHERE origin < destination""")
def distance_matrix(t: AnalogTables) -> DataFrame:
    """Distances of all city pairs that a route connects or a request names."""
    pair = routes.PAIR
    pairs = t.routes().select(*pair).unionByName(t.trip_requests().select(*pair))
    return cities.connected_distances(pairs, t.cities()).withColumn("km", F.round("km", 4))


@query("""
SELECT service_provider, route_id, origin, destination, traveldate, partner, cost,
       CASE WHEN service_provider = 'drive-now' THEN 0 ELSE 1 END AS provider_rank FROM v_routes""")
def provider_union(t: AnalogTables) -> DataFrame:
    stored = t.routes()
    parts = {p: stored.where(F.col("service_provider") == p).drop("service_provider") for p in PROVIDERS}
    return routes.provider_union(parts)


@query("""
SELECT r.* FROM v_routes r
WHERE EXISTS (SELECT 1 FROM v_trip_requests q WHERE q.origin = r.origin AND q.destination = r.destination)""")
def routes_by_pair(t: AnalogTables) -> DataFrame:
    return routes.routes_by_pair(t.trip_requests(), t.routes())


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def event_days(t: AnalogTables) -> DataFrame:
    return t.table("events").select("event_id", day_of_time(F.col("ts")).alias("day"))


TRIPS = f"""
SELECT p.origin, p.destination, p.requests, p.status, p.distance, COALESCE(l.page, 0) AS page,
       COALESCE(l.routes, '[]') AS routes
FROM v_pairs p LEFT JOIN (
  SELECT origin, destination, CAST(row_no // {PAGE_SIZE} AS INT) AS page,
         CAST(to_json(list({{'route_id': route_id, 'origin': origin, 'destination': destination, 'date': date,
           'partner': partner, 'cost': cost, 'service_provider': service_provider}} ORDER BY row_no)) AS VARCHAR) AS routes
  FROM v_rows GROUP BY ALL) l
ON p.origin = l.origin AND p.destination = l.destination"""


@query(TRIPS)
def trip_search(t: AnalogTables) -> DataFrame:
    """Answer pages of every asked pair, the list as JSON text."""
    answers = trips.trip_search(t.trip_requests(), t.cities(), t.routes(), PAGE_SIZE)
    return answers.withColumn("routes", F.to_json("routes", {"ignoreNullFields": "false"}))


@query(TRIPS)
def trip_search_stored(t: AnalogTables) -> DataFrame:
    """The same over routes that are stored in buckets by pair."""
    store = PairRoutes(t.spark, f"routes_{uuid.uuid4().hex}", fresh_path(t.spark, "pair-routes"))
    store.write(t.stored_routes(), buckets=8)
    answers = trips.trip_search(t.trip_requests(), t.cities(), store, PAGE_SIZE)
    return answers.withColumn("routes", F.to_json("routes", {"ignoreNullFields": "false"}))


@query(f"""
SELECT p.origin, p.destination, COALESCE(l.page, 0) AS page,
       CAST(to_json({{'distance': p.distance, 'routes': COALESCE(l.routes, [])}}) AS VARCHAR) AS body
FROM v_pairs p LEFT JOIN (
  SELECT origin, destination, CAST(row_no // {PAGE_SIZE} AS INT) AS page,
         list({{'routeId': route_id, 'origin': origin, 'destination': destination, 'date': date_text,
           'partner': partner, 'cost': cost, 'serviceProvider': service_provider}} ORDER BY row_no) AS routes
  FROM v_rows GROUP BY ALL) l
ON p.origin = l.origin AND p.destination = l.destination""")
def trip_search_json(t: AnalogTables) -> DataFrame:
    return trip_bodies(trips.trip_search(t.trip_requests(), t.cities(), t.routes(), PAGE_SIZE))


@query("""
SELECT origin, destination, distance, row_no, service_provider, route_id, date, date_text, partner, cost,
       '/accounting-core-service/' || service_provider || '/' || CAST(route_id AS VARCHAR) || '/book' AS link
FROM v_rows""")
def trip_rows_indexed(t: AnalogTables) -> DataFrame:
    return trips.trip_rows(t.trip_requests(), t.cities(), t.routes())


@query("""
SELECT t.request_id, t.origin, t.destination, t.status, t.distance,
       CASE WHEN t.status = 'ok' THEN COALESCE(n.routes, 0) ELSE 0 END AS route_count
FROM v_trips t LEFT JOIN (SELECT origin, destination, COUNT(*) AS routes FROM v_routes GROUP BY ALL) n
ON t.origin = n.origin AND t.destination = n.destination""")
def request_answers(t: AnalogTables) -> DataFrame:
    return trips.request_answers(t.trip_requests(), t.cities(), t.routes())
