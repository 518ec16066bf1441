"""User and role lookups. Passwords are never read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.functions.traces import folded
from tripspark.operators.lists import PAGE_SIZE, pages
from tripspark.operators.skew import lookup_join


def _named(df: DataFrame, ignore_case: bool) -> DataFrame:
    return df.withColumn("_name", folded(F.col("username"), ignore_case))


def user_lookup(users: DataFrame, names: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Users are unique by name, so no name can hold many of them."""
    wanted = _named(names, ignore_case).select("_name").distinct()
    return _named(users.select("username", "enabled"), ignore_case).join(wanted, "_name", "left_semi").drop("_name")


def role_lookup(user_roles: DataFrame, names: DataFrame, ignore_case: bool = False) -> DataFrame:
    rows = _named(user_roles.select("username", "role"), ignore_case)
    return lookup_join(rows, _named(names, ignore_case), ["_name"], "left_semi").drop("_name")


def users_with_roles(users: DataFrame, user_roles: DataFrame) -> DataFrame:
    """One row per user and role; users without a role stay with NULL."""
    roles = user_roles.select("username", "role").distinct()
    return users.select("username", "enabled").join(roles, "username", "left")


def access_report(users: DataFrame, user_roles: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Users with their sorted roles; more than `page_size` roles go to further pages."""
    roles = pages(user_roles, ["username"], ["role"], "roles", page_size, distinct=True)
    return users.select("username", "enabled").join(roles, "username", "left")
