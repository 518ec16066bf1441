"""Checks of keys, references and values over all derived tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.operators import booking, integrity
from tripspark.operators.integrity import TableRules
from tripspark.operators.spans import SPAN_KEY
from tripspark.operators.tracestore import ANNOTATION_KEY
from tripspark.queries.registry import query
from tripspark.schemas import LENGTHS, VALUE_BYTES
from tripspark.sources.analog import AnalogTables
from tripspark.vocabulary import PROVIDERS


@query("""
SELECT q.*, 'trip_requests.destination -> cities' AS rule FROM v_trip_requests q
WHERE q.destination NOT IN (SELECT city_id FROM v_cities)""")
def unknown_destinations(t: AnalogTables) -> DataFrame:
    return integrity.check_foreign_key(
        t.trip_requests(), "destination", t.cities(), "city_id", "trip_requests.destination -> cities"
    )


@query("""
SELECT q.*, 'booking_requests.service' AS rule FROM v_booking_requests q
WHERE service NOT IN ('drive-now', 'deutsche-bahn')""")
def unknown_providers(t: AnalogTables) -> DataFrame:
    return integrity.check_domain(t.booking_requests(), "service", list(PROVIDERS), "booking_requests.service")


@query("""
SELECT l_orderkey, l_linenumber, COUNT(*) AS rows, 'lineitem key' AS rule
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def duplicate_line_items(t: AnalogTables) -> DataFrame:
    return integrity.check_unique(t.table("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem key")


@query("""
SELECT 'parent_id' AS column_name, COUNT(*) FILTER (parent_id IS NULL) AS nulls FROM v_spans
UNION ALL SELECT 'name', COUNT(*) FILTER (name IS NULL) FROM v_spans
UNION ALL SELECT 'start_ts', COUNT(*) FILTER (start_ts IS NULL) FROM v_spans
UNION ALL SELECT 'duration', COUNT(*) FILTER (duration IS NULL) FROM v_spans""")
def span_nulls(t: AnalogTables) -> DataFrame:
    return integrity.null_counts(t.spans(), ["parent_id", "name", "start_ts", "duration"])


@query("""
SELECT 'cities key' AS rule, COUNT(*) - COUNT(DISTINCT city_id) AS violations FROM v_cities
UNION ALL SELECT 'cities length', COUNT(*) FILTER (length(city_name) > 25) FROM v_cities
UNION ALL SELECT 'routes key', COUNT(*) FROM
  (SELECT 1 FROM v_routes GROUP BY service_provider, route_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'routes.origin -> cities', COUNT(*) FROM v_routes WHERE origin NOT IN (SELECT city_id FROM v_cities)
UNION ALL SELECT 'routes.destination -> cities', COUNT(*) FROM v_routes WHERE destination NOT IN (SELECT city_id FROM v_cities)
UNION ALL SELECT 'routes not null', COUNT(*) FILTER (route_id IS NULL) FROM v_routes
UNION ALL SELECT 'routes length', COUNT(*) FILTER (length(partner) > 30) FROM v_routes
UNION ALL SELECT 'booked -> routes', COUNT(*) FROM v_results WHERE status = 'missing'
UNION ALL SELECT 'trip_requests.destination -> cities', COUNT(*) FROM v_trip_requests
  WHERE destination NOT IN (SELECT city_id FROM v_cities)
UNION ALL SELECT 'booking_requests.service', COUNT(*) FROM v_booking_requests
  WHERE service NOT IN ('drive-now', 'deutsche-bahn')
UNION ALL SELECT 'users key', COUNT(*) - COUNT(DISTINCT username) FROM v_users
UNION ALL SELECT 'user_roles key', COUNT(*) FROM (SELECT 1 FROM v_user_roles GROUP BY role, username HAVING COUNT(*) > 1)
UNION ALL SELECT 'user_roles -> users', COUNT(*) FROM v_user_roles WHERE username NOT IN (SELECT username FROM v_users)
UNION ALL SELECT 'spans key', COUNT(*) FROM
  (SELECT 1 FROM v_spans GROUP BY trace_id_high, trace_id, id HAVING COUNT(*) > 1)
UNION ALL SELECT 'spans not null', COUNT(*) FILTER (trace_id IS NULL OR id IS NULL OR name IS NULL) FROM v_spans
UNION ALL SELECT 'spans length', COUNT(*) FILTER (length(name) > 255) FROM v_spans
UNION ALL SELECT 'annotations key', COUNT(*) FROM
  (SELECT 1 FROM v_annotations GROUP BY trace_id_high, trace_id, span_id, a_key, a_timestamp HAVING COUNT(*) > 1)
UNION ALL SELECT 'annotations not null', COUNT(*) FILTER (trace_id IS NULL OR span_id IS NULL OR a_key IS NULL) FROM v_annotations
UNION ALL SELECT 'annotations value size', COUNT(*) FILTER (strlen(a_value) >= 65536) FROM v_annotations
UNION ALL SELECT 'annotations length', COUNT(*) FILTER (length(a_key) > 255 OR length(endpoint_service_name) > 255)
  FROM v_annotations""")
def integrity_report(t: AnalogTables) -> DataFrame:
    """Violations per rule, with one pass over each table and one shuffle."""
    # As if every request of a known provider had been booked, so that some have no route.
    booked = F.when(booking.known_provider(F.col("service")), booking.stored_name(F.col("service")))

    def null(*columns: str):
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])

    def long(table: str):
        return reduce(lambda a, b: a | b, [F.length(c) > n for c, n in LENGTHS[table].items()])

    return integrity.violations(
        [
            TableRules(
                t.cities(),
                keys={"cities key": ["city_id"]},
                parents={
                    "routes.origin -> cities": ["city_id"],
                    "routes.destination -> cities": ["city_id"],
                    "trip_requests.destination -> cities": ["city_id"],
                },
                broken={"cities length": long("cities")},
            ),
            TableRules(
                t.routes(),
                keys={"routes key": ["service_provider", "route_id"]},
                children={"routes.origin -> cities": ["origin"], "routes.destination -> cities": ["destination"]},
                parents={"booked -> routes": [booking.stored_name(F.col("service_provider")), "route_id"]},
                broken={"routes not null": null("route_id"), "routes length": long("routes")},
            ),
            TableRules(t.trip_requests(), children={"trip_requests.destination -> cities": ["destination"]}),
            TableRules(
                t.booking_requests(),
                children={"booked -> routes": [booked, "route_id"]},
                broken={"booking_requests.service": ~F.col("service").isin(*PROVIDERS)},
            ),
            TableRules(t.users(), keys={"users key": ["username"]}, parents={"user_roles -> users": ["username"]}),
            TableRules(t.user_roles(), keys={"user_roles key": ["role", "username"]}, children={"user_roles -> users": ["username"]}),
            TableRules(
                t.spans(parents=False),
                keys={"spans key": SPAN_KEY},
                broken={"spans not null": null("trace_id", "id", "name"), "spans length": long("spans")},
            ),
            TableRules(
                t.annotations(),
                keys={"annotations key": ANNOTATION_KEY},
                broken={
                    "annotations not null": null("trace_id", "span_id", "a_key"),
                    "annotations value size": F.octet_length("a_value") >= VALUE_BYTES,
                    "annotations length": long("annotations"),
                },
            ),
        ]
    )
