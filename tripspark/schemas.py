"""Table schemas."""

from __future__ import annotations

from pyspark.sql.types import StructType

CITIES = "city_id INT NOT NULL, city_name STRING, latitude DOUBLE, longitude DOUBLE"
ROUTES = "route_id INT NOT NULL, origin INT, destination INT, traveldate TIMESTAMP_NTZ, partner STRING, cost INT"
BOOKED_ROUTES = "id BIGINT NOT NULL, service_provider STRING, route_id BIGINT, booking_time TIMESTAMP_NTZ"
# No password column: nothing here needs one.
USERS = "username STRING NOT NULL, enabled BOOLEAN NOT NULL"
USER_ROLES = "user_role_id INT NOT NULL, username STRING NOT NULL, role STRING NOT NULL"
SPANS = (
    "trace_id_high BIGINT NOT NULL, trace_id BIGINT NOT NULL, id BIGINT NOT NULL, name STRING NOT NULL, "
    "parent_id BIGINT, debug BOOLEAN, start_ts BIGINT, duration BIGINT, scanned BOOLEAN"
)
ANNOTATIONS = (
    "trace_id_high BIGINT NOT NULL, trace_id BIGINT NOT NULL, span_id BIGINT NOT NULL, a_key STRING NOT NULL, "
    "a_value BINARY, a_type INT NOT NULL, a_timestamp BIGINT, endpoint_ipv4 INT, endpoint_ipv6 BINARY, "
    "endpoint_port INT, endpoint_service_name STRING, scanned BOOLEAN"
)
DEPENDENCIES = "day DATE NOT NULL, parent STRING NOT NULL, child STRING NOT NULL, call_count BIGINT"
TRIP_REQUESTS = "request_id BIGINT, origin INT, destination INT"
BOOKING_REQUESTS = "request_id BIGINT, service STRING, route_id BIGINT"

TABLES: dict[str, str] = {
    "cities": CITIES,
    "drivenow_routes": ROUTES,
    "deutschebahn_routes": ROUTES,
    "booked_routes": BOOKED_ROUTES,
    "users": USERS,
    "user_roles": USER_ROLES,
    "spans": SPANS,
    "annotations": ANNOTATIONS,
    "dependencies": DEPENDENCIES,
    "trip_requests": TRIP_REQUESTS,
    "booking_requests": BOOKING_REQUESTS,
}

# Longest text each column may hold.
LENGTHS: dict[str, dict[str, int]] = {
    "cities": {"city_name": 25},
    "routes": {"partner": 30},
    "users": {"username": 45},
    "user_roles": {"username": 45, "role": 45},
    "spans": {"name": 255},
    "annotations": {"a_key": 255, "endpoint_service_name": 255},
}
VALUE_BYTES = 65536  # an annotation value must be smaller than this

# Values of columns left out on insert.
DEFAULTS: dict[str, dict[str, object]] = {
    "users": {"enabled": True},
    "spans": {"trace_id_high": 0},
    "annotations": {"trace_id_high": 0},
}


def struct_of(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def required_columns(table: str) -> list[str]:
    return [f.name for f in struct_of(table).fields if not f.nullable]
