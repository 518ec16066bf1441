"""JSON answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.functions.times import time_text


def route_body() -> Column:
    """A route of a list as it is named in answers."""
    return F.transform(
        "routes",
        lambda r: F.struct(
            r["route_id"].alias("routeId"),
            r["origin"].alias("origin"),
            r["destination"].alias("destination"),
            time_text(r["date"]).alias("date"),
            r["partner"].alias("partner"),
            r["cost"].alias("cost"),
            r["service_provider"].alias("serviceProvider"),
        ),
    )


def trip_bodies(answers: DataFrame) -> DataFrame:
    """JSON text of every answer page, NULLs included."""
    body = F.struct("distance", route_body().alias("routes"))
    return answers.select(
        "origin", "destination", "page", F.to_json(body, {"ignoreNullFields": "false"}).alias("body")
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
