from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_spans import NOTES, SPANS, note
from tripspark.operators import access, integrity
from tripspark.operators.spans import SPAN_KEY
from tripspark.operators.tracestore import ANNOTATION_KEY
from tripspark.schemas import DEFAULTS, VALUE_BYTES, required_columns, struct_of
from tripspark.sinks.tables import append_rows, ensure_table
from tripspark.sources.seed import seed_table


@pytest.fixture(scope="module")
def users(spark):
    return seed_table(spark, "users").union(spark.createDataFrame([("ann", True), ("bob", False)], "username STRING, enabled BOOLEAN"))


@pytest.fixture(scope="module")
def roles(spark):
    more = [(2, "ann", "ROLE_B"), (3, "ann", "ROLE_A"), (4, "ann", "ROLE_A"), (5, "eve", "ROLE_A")]
    return seed_table(spark, "user_roles").union(spark.createDataFrame(more, struct_of("user_roles")))


def test_lookups(spark, users, roles):
    names = spark.createDataFrame([("ann",), ("ann",), ("nobody",)], "username STRING")
    assert rows(access.user_lookup(users, names)) == [("ann", True)]
    assert rows(access.role_lookup(roles, names)) == [("ann", "ROLE_A"), ("ann", "ROLE_A"), ("ann", "ROLE_B")]


def test_lookups_without_case(spark, users, roles):
    names = spark.createDataFrame([("ANN",)], "username STRING")
    assert access.user_lookup(users, names).count() == 0
    assert rows(access.user_lookup(users, names, ignore_case=True)) == [("ann", True)]
    assert access.role_lookup(roles, names, ignore_case=True).count() == 3


def test_access_report(users, roles):
    report = {r["username"]: r["roles"] for r in access.access_report(users, roles).collect()}
    assert report == {"user": ["ROLE_ADMIN"], "ann": ["ROLE_A", "ROLE_B"], "bob": None}
    assert access.users_with_roles(users, roles).count() == 4


def test_many_roles_are_paged(spark, users):
    many = spark.createDataFrame([(i, "ann", f"ROLE_{i}") for i in range(100)], struct_of("user_roles"))
    pages = access.access_report(users, many, page_size=10).where("username = 'ann'").collect()
    assert len(pages) > 5 and sum(len(p["roles"]) for p in pages) == 100


def test_unique(spark, roles):
    assert rows(integrity.check_unique(roles, ["role", "username"], "uni")) == [("ROLE_A", "ann", 2, "uni")]
    spans = spark.createDataFrame(SPANS + [SPANS[0]], struct_of("spans"))
    assert rows(integrity.check_unique(spans, SPAN_KEY, "spans"), "id", "rows") == [(10, 2)]
    timeless = spark.createDataFrame(NOTES + [note(16, time=None)], struct_of("annotations"))
    assert integrity.check_unique(timeless, ANNOTATION_KEY, "notes").count() == 0


@pytest.mark.parametrize("heavy", [False, True])
def test_foreign_key(spark, users, roles, heavy, request):
    if heavy:
        request.getfixturevalue("force_hot")
    orphans = integrity.check_foreign_key(roles, "username", users, "username", "fk")
    assert rows(orphans, "username", "rule") == [("eve", "fk")]
    assert orphans.columns == [*roles.columns, "rule"]
    child = spark.createDataFrame([(None,), (1,), (9,), (9,), (9,)], "c INT")
    parent = spark.createDataFrame([(1,), (1,)], "p INT")
    assert rows(integrity.check_foreign_key(child, "c", parent, "p", "fk"), "c") == [(9,)] * 3


def test_booking_orphans(spark, routes):
    booked = spark.createDataFrame([(1, "drivenow", 1), (2, "drivenow", 8), (3, "deutschebahn", 8)], "id INT, service_provider STRING, route_id INT")
    assert rows(integrity.check_booking_orphans(booked, routes, "orphan"), "id", "rule") == [(2, "orphan")]


def test_values(spark):
    df = spark.createDataFrame([("drivenow", "x" * 26), (None, None), ("other", "ok")], "p STRING, name STRING")
    assert rows(integrity.check_domain(df, "p", ["drivenow", "deutschebahn"], "enum"), "p", "rule") == [("other", "enum")]
    assert rows(integrity.check_not_null(df, ["p", "name"], "nn"), "rule") == [("nn",)]
    assert integrity.check_length(df, "name", 25, "len").count() == 1
    assert rows(integrity.null_counts(df, ["p", "name"])) == [("name", 1), ("p", 1)]
    values = spark.createDataFrame([(bytes(VALUE_BYTES),), (bytes(VALUE_BYTES - 1),), (None,)], "v BINARY")
    assert integrity.check_value_size(values, "v", VALUE_BYTES, "size").count() == 1


def test_counts(spark):
    df = spark.createDataFrame([(1,), (5,)], "n INT")
    counted = integrity.count_broken(df, {"t.n large": F.col("n") > 2, "negative": F.col("n") < 0})
    assert rows(counted) == [("negative", 0), ("t.n large", 1)]
    assert rows(integrity.count_violations(df.where("n > 9"), "none")) == [("none", 0)]


def test_defaults(spark):
    df = spark.createDataFrame([("a", None), ("b", False)], "username STRING, enabled BOOLEAN")
    assert rows(integrity.with_defaults(df, DEFAULTS["users"])) == [("a", True), ("b", False)]
    assert required_columns("spans") == ["trace_id_high", "trace_id", "id", "name"]
    assert "password" not in struct_of("users").fieldNames()


def test_target_is_created_once(spark, tmp_path):
    path = str(tmp_path / "users")
    for _ in range(2):
        ensure_table(spark, "tripspark_users", "username STRING, enabled BOOLEAN", path)
        append_rows(seed_table(spark, "users"), path)
    assert spark.read.parquet(path).count() == 2
    spark.sql("DROP TABLE tripspark_users")
