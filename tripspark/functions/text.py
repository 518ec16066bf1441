"""Text expressions of trip answers and the service list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripspark.functions.geo import two_decimals
from tripspark.vocabulary import BOOKING_LINK_PREFIX, CITY_ERROR_BODY


def booking_link(service_provider: Column, route_id: Column) -> Column:
    """NULL when a part is NULL."""
    return F.concat(
        F.lit(BOOKING_LINK_PREFIX), service_provider, F.lit("/"), route_id.cast("string"), F.lit("/book")
    )


def distance_label(distance: Column) -> Column:
    return F.concat(distance.cast("string"), F.lit(" Km"))


def service_url(service: Column) -> Column:
    return F.concat(service, F.lit("/routes"))


def distance_body(km: Column) -> Column:
    """JSON text of one distance answer; the error text where there is no distance."""
    found = F.concat(F.lit('{"result": '), two_decimals(km), F.lit("}"))
    return F.when(km.isNotNull(), found).otherwise(F.lit(CITY_ERROR_BODY))


def parse_distance(body: Column) -> Column:
    """The number in a distance answer; NULL for an error text or broken JSON."""
    return F.try_element_at(F.from_json(body, "map<string,double>"), F.lit("result"))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))
