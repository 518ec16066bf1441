"""The seed rows as DataFrames. Fixed values."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tripspark.schemas import struct_of

CITIES = [(1, "Munich", 48.1351, 11.582), (2, "Frankfurt", 50.1109, 8.6821), (3, "Berlin", 52.52, 13.405)]

CAR_ROUTES = [
    (1, 1, 2, datetime(2017, 1, 2, 7), "Chris", 30),
    (2, 1, 2, datetime(2017, 1, 3, 10), "Ana", 35),
    (3, 1, 3, datetime(2017, 2, 3, 12), "John", 25),
    (4, 2, 3, datetime(2017, 2, 3, 14), "Arnold", 45),
]

RAIL_ROUTES = [
    (1, 3, 2, datetime(2017, 1, 1, 7), "DB", 60),
    (2, 2, 1, datetime(2017, 1, 7, 10), "TGV", 75),
    (3, 3, 1, datetime(2017, 2, 5, 12), "RailJet", 85),
    (4, 2, 1, datetime(2017, 2, 4, 14), "DB", 65),
    (5, 1, 3, datetime(2017, 1, 1, 8), "DB", 20),
    (6, 3, 1, datetime(2017, 1, 7, 9), "TGV", 75),
    (7, 3, 2, datetime(2017, 2, 5, 12), "RailJet", 85),
    (8, 3, 1, datetime(2017, 2, 4, 15), "DB", 95),
]

USERS = [("user", True)]
USER_ROLES = [(1, "user", "ROLE_ADMIN")]

ROWS = {
    "cities": CITIES,
    "drivenow_routes": CAR_ROUTES,
    "deutschebahn_routes": RAIL_ROUTES,
    "users": USERS,
    "user_roles": USER_ROLES,
}


def seed_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(ROWS[name], struct_of(name))


def seed_routes(spark: SparkSession) -> dict[str, DataFrame]:
    """Routes by provider."""
    return {
        "drive-now": seed_table(spark, "drivenow_routes"),
        "deutsche-bahn": seed_table(spark, "deutschebahn_routes"),
    }


def load_seed(spark: SparkSession, folder: str) -> None:
    """Write the seed tables as Parquet, readable with `load_table`."""
    for name in ROWS:
        seed_table(spark, name).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
