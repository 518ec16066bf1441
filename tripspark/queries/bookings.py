"""Booking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.operators import booking
from tripspark.queries.registry import query
from tripspark.sources.analog import AnalogTables

FIXED_TIME = "TIMESTAMP_NTZ '2024-02-01 12:00:00'"


@query("SELECT * FROM v_results")
def booking_results(t: AnalogTables) -> DataFrame:
    return booking.book(t.booking_requests(), t.routes(), F.expr(FIXED_TIME))


@query("""
SELECT ROW_NUMBER() OVER (ORDER BY request_id) AS id, service_provider, route_id, booking_time
FROM v_results WHERE status = 'booked'""")
def booked_routes(t: AnalogTables) -> DataFrame:
    return booking.booked_rows(booking.book(t.booking_requests(), t.routes(), F.expr(FIXED_TIME)))


@query("SELECT request_id, service, route_id FROM v_results WHERE status = 'booked'")
def bookable_requests(t: AnalogTables) -> DataFrame:
    return booking.bookable_requests(t.booking_requests(), t.routes())


@query("SELECT request_id, service, route_id FROM v_results WHERE status = 'missing'")
def booking_missing(t: AnalogTables) -> DataFrame:
    return booking.missing_requests(t.booking_requests(), t.routes())


@query("SELECT request_id, service, route_id FROM v_results WHERE status = 'invalid'")
def booking_invalid(t: AnalogTables) -> DataFrame:
    return booking.invalid_requests(t.booking_requests())
