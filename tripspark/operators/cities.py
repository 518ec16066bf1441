"""City lookups and distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.functions.geo import haversine_km

CITY_COLUMNS = ["city_id", "city_name", "latitude", "longitude"]


def city_list(cities: DataFrame) -> DataFrame:
    return cities.select(*CITY_COLUMNS)


def cities_by_id(cities: DataFrame, *ids: int) -> DataFrame:
    return cities.select(*CITY_COLUMNS).where(F.col("city_id").isin(*ids))


def requested_cities(requests: DataFrame, cities: DataFrame) -> DataFrame:
    """Cities that some request names as origin or destination."""
    named = requests.select(F.explode(F.array("origin", "destination")).alias("city_id")).distinct()
    return cities.select(*CITY_COLUMNS).join(named, "city_id", "left_semi")


def city_pair_distance(requests: DataFrame, cities: DataFrame) -> DataFrame:
    """Adds `km`, `distance` (two decimals) and `status` to rows with an origin and a destination.

    Both cities must be known and differ; other rows keep NULL distances and status 'error'. There is no
    broadcast hint: Spark compares the size of `cities` with its broadcast threshold.
    """

    def end(side: str) -> DataFrame:
        return cities.select(
            F.col("city_id").alias(side), F.col("latitude").alias(f"_lat_{side}"), F.col("longitude").alias(f"_lon_{side}"),
            F.lit(True).alias(f"_known_{side}"),
        )

    joined = requests.join(end("origin"), "origin", "left").join(end("destination"), "destination", "left")
    valid: Column = (
        F.col("_known_origin").isNotNull()
        & F.col("_known_destination").isNotNull()
        & (F.col("origin") != F.col("destination"))
    )
    km = haversine_km(
        F.col("_lat_origin"), F.col("_lon_origin"), F.col("_lat_destination"), F.col("_lon_destination")
    )
    return joined.select(
        *requests.columns,
        F.when(valid, km).alias("km"),
        F.when(valid, F.round(km, 2)).alias("distance"),
        F.when(valid, F.lit("ok")).otherwise(F.lit("error")).alias("status"),
    )


def connected_distances(pairs: DataFrame, cities: DataFrame) -> DataFrame:
    """Distance of every two cities that appear together in `pairs`, once per unordered pair.

    Pairs come from the data: combining all cities with each other would grow with the square of their number.
    """
    unordered = (
        pairs.select(
            F.least("origin", "destination").alias("origin"), F.greatest("origin", "destination").alias("destination")
        )
        .where(F.col("origin") != F.col("destination"))
        .distinct()
    )
    return (
        city_pair_distance(unordered, cities)
        .where(F.col("status") == "ok")
        .select(F.col("origin").alias("city_a"), F.col("destination").alias("city_b"), "km", "distance")
    )
