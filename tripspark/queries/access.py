"""Users and roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.operators import access
from tripspark.queries.registry import query
from tripspark.sources.analog import AnalogTables

BUYERS = "(SELECT c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))"


def _buyers(t: AnalogTables) -> DataFrame:
    """Names of customers with an order."""
    orders = t.table("orders").select(F.col("o_custkey").alias("c_custkey"))
    return t.table("customer").join(orders, "c_custkey", "left_semi").select(F.col("c_name").alias("username"))


@query(f"SELECT username, enabled FROM v_users WHERE username IN {BUYERS}")
def user_lookup(t: AnalogTables) -> DataFrame:
    return access.user_lookup(t.users(), _buyers(t))


@query(f"SELECT username, role FROM v_user_roles WHERE username IN {BUYERS}")
def role_lookup(t: AnalogTables) -> DataFrame:
    return access.role_lookup(t.user_roles(), _buyers(t))


@query("""
SELECT u.username, u.enabled, r.role
FROM v_users u LEFT JOIN (SELECT DISTINCT username, role FROM v_user_roles) r ON u.username = r.username""")
def users_with_roles(t: AnalogTables) -> DataFrame:
    return access.users_with_roles(t.users(), t.user_roles())


@query("""
SELECT u.username, u.enabled, CASE WHEN r.roles IS NOT NULL THEN 0 END AS page, r.roles
FROM v_users u LEFT JOIN (
  SELECT username, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM v_user_roles GROUP BY username) r
ON u.username = r.username""")
def access_report(t: AnalogTables) -> DataFrame:
    return access.access_report(t.users(), t.user_roles()).withColumn("roles", F.array_join("roles", ","))
