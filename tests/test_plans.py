"""Physical plans of the registered batch queries, and counts of the derived tables."""

from __future__ import annotations

import re

import pytest

from tests.conftest import DATA
from tripspark.operators import booking, routes, spans
from tripspark.queries import QUERIES
from tripspark.sources.analog import AnalogTables

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_row_products(spark, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    for part in ("PythonUDF", "EvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert part not in plan, part
    # a window without partition would put all rows in one task
    for window in re.findall(r"Window \[.*", plan):
        assert re.search(r"windowspecdefinition\([a-z_]+[^ ]*#\d+L?,", window), window


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["span_names"](spark, DATA))
    assert "ReadSchema: struct<event_type:string>" in plan
    plan = plan_of(QUERIES["booking_missing"](spark, DATA))
    assert "l_extendedprice" not in plan and "p_brand" not in plan


def test_filters_reach_the_scan(spark, tables):
    plan = plan_of(tables.spans(parents=False).where("trace_id = 7 AND name = 'error'"))
    assert "EqualTo(user_id,7)" in plan and "EqualTo(event_type,error)" in plan


def test_cities_are_broadcast(spark):
    plan = plan_of(QUERIES["city_pair_distance"](spark, DATA))
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan


@pytest.fixture(scope="module")
def larger(spark):
    return AnalogTables(spark, "/root/testdata/sf0.01")


def test_known_counts_of_trips(larger):
    counts = {r["service_provider"]: r["count"] for r in larger.routes().groupBy("service_provider").count().collect()}
    assert counts == {"drive-now": 26215, "deutsche-bahn": 26052}
    assert routes.requests_with_routes(larger.trip_requests(), larger.routes()).where("route_id IS NOT NULL").count() == 121200


def test_known_counts_of_bookings(larger):
    results = booking.book(larger.booking_requests(), larger.routes())
    assert {r["status"]: r["count"] for r in results.groupBy("status").count().collect()} == {
        "booked": 1477, "missing": 4504, "invalid": 9019
    }


def test_known_counts_of_traces(larger):
    joined = spans.span_rows(larger.spans(), larger.annotations(), parity=True)
    assert joined.count() == 6666 and joined.where("span_id IS NOT NULL").count() == 6000
