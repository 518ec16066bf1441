from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_spans import note, span
from tripspark.functions.traces import trace_key, trace_key_text
from tripspark.operators import tracestore
from tripspark.plans.catalogue import catalogue_of
from tripspark.schemas import struct_of
from tripspark.sinks.tables import NO_DAY, day_range, expire_days, write_by_day, write_day_table

DAY = 86_400_000_000


@pytest.fixture(scope="module")
def spans(spark):
    return spark.createDataFrame(
        [
            span(1, name="get", start=10, duration=100),
            span(2, parent=1, name="post", start=20, duration=None),
            span(3, parent=1, name="GET", start=30, duration=300),
            span(4, parent=3, name="put", start=DAY + 5, duration=400),
            span(1, trace=2, name="get", start=5, duration=50),
            span(9, trace=2, parent=8, name="lost", start=None, duration=50),
        ],
        struct_of("spans"),
    )


@pytest.fixture(scope="module")
def notes(spark):
    return spark.createDataFrame(
        [
            note(1, "cs", None, 12, kind=-1, service="zeta-mobility-service"),
            note(1, "sr", None, 11, kind=-1, service="alpha-mobility-service"),
            note(1, "sr2", None, 11, kind=-1, service="beta-core-service"),
            note(2, "http", b"x", 21, service="beta-core-service"),
            note(3, "http", b"b", 31, service="alpha-mobility-service"),
            note(3, "http", b"a", 32, service="alpha-mobility-service"),
            note(4, "size", b"1", 41, service="beta-core-service"),
            note(4, "none", b"1", 40, service=None),
            note(1, "http", b"x", 6, trace=2, service="Alpha-mobility-service"),
        ],
        struct_of("annotations"),
    )


def test_services(notes, spans):
    assert rows(tracestore.service_names(notes)) == [
        ("Alpha-mobility-service",), ("alpha-mobility-service",), ("beta-core-service",), ("zeta-mobility-service",)
    ]
    assert tracestore.service_names(notes, ignore_case=True).count() == 3
    assert ("zeta-mobility-service", "zeta-mobility-service/routes") in rows(catalogue_of(notes))
    assert catalogue_of(notes).count() == 3
    owners = {(r["trace_id"], r["id"]): r["service"] for r in tracestore.with_service(spans, notes).collect()}
    assert owners[(1, 1)] == "alpha-mobility-service"  # earliest, then by name
    assert owners[(1, 4)] == "beta-core-service" and owners[(2, 9)] is None


def test_span_names(spans, notes):
    assert tracestore.span_names(spans).count() == 5
    assert tracestore.span_names(spans, ignore_case=True).count() == 4
    named = rows(tracestore.span_names_of_services(spans, notes))
    assert ("alpha-mobility-service", "GET") in named and ("beta-core-service", "put") in named and len(named) == 5


def test_links(spans, notes):
    links = rows(tracestore.dependency_links(spans, notes), "parent", "child", "call_count")
    # span 3 has its parent's service, span 9 has no stored parent
    assert links == [("alpha-mobility-service", "beta-core-service", 1), ("alpha-mobility-service", "beta-core-service", 1)]
    days = rows(tracestore.dependency_links(spans, notes), "day")
    assert [str(d[0]) for d in days] == ["1970-01-01", "1970-01-02"]


def test_links_count_every_child(spark):
    spans = spark.createDataFrame([span(1)] + [span(i, parent=1) for i in range(2, 202)], struct_of("spans"))
    notes = spark.createDataFrame([note(1, service="a")] + [note(i, service="b") for i in range(2, 202)], struct_of("annotations"))
    assert rows(tracestore.dependency_links(spans, notes), "parent", "child", "call_count") == [("a", "b", 200)]


@pytest.mark.parametrize(
    "conditions, traces",
    [
        ({}, {1, 2}),
        ({"name": "post"}, {1}),
        ({"name": "get"}, {1, 2}),
        ({"name": "Post", "ignore_case": True}, {1}),
        ({"service": "Alpha-mobility-service"}, {2}),
        ({"service": "alpha-mobility-service", "ignore_case": True}, {1, 2}),
        ({"key": "size"}, {1}),
        ({"key": "size", "a_type": -1}, set()),
        ({"a_type": -1}, {1}),
        ({"name": "post", "key": "size"}, set()),  # not on the same span
        ({"start": 5, "end": 5}, {2}),
        ({"min_duration": 400, "max_duration": 400}, {1}),
        ({"min_duration": 401}, set()),
        ({"max_duration": 50}, {2}),
    ],
)
def test_find_traces(spans, notes, conditions, traces):
    found = tracestore.find_traces(spans, notes, **conditions)
    assert {r["trace_id"] for r in found.collect()} == traces
    assert found.count() == spans.where(F.col("trace_id").isin(*traces)).count()


def test_traces_by_ids(spark, spans, notes, force_hot):
    ids = spark.createDataFrame([(0, 1), (0, 1), (5, 2)], "trace_id_high BIGINT, trace_id BIGINT")
    found = tracestore.traces_by_ids(spans, ids)
    assert sorted(r["id"] for r in found.collect()) == [1, 2, 3, 4]
    nested = {r["id"]: r for r in tracestore.with_annotation_pages(found, notes).collect()}
    assert [len(nested[i]["annotations"]) for i in (1, 2, 3, 4)] == [3, 1, 2, 2]
    empty = {r["id"]: r for r in tracestore.with_annotation_pages(spans, notes).where("trace_id = 2").collect()}
    assert empty[9]["annotations"] == [] and empty[9]["page"] == 0


def test_annotation_pages_hold_everything(spark, spans):
    many = spark.createDataFrame([note(1, "k", b"same", 7) for _ in range(30)] + [note(1, f"k{i}") for i in range(70)], struct_of("annotations"))
    pages = tracestore.with_annotation_pages(spans.where("trace_id = 1 AND id = 1"), many, page_size=10).collect()
    assert sum(len(p["annotations"]) for p in pages) == 100 and len(pages) > 5


def test_order(spans):
    assert [r["trace_id"] for r in tracestore.traces_by_start(spans).collect()] == [1, 2]
    assert [r["trace_id"] for r in tracestore.traces_by_start(spans, 1).collect()] == [1]
    plan = tracestore.traces_by_start(spans, 1)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_retention(spans):
    assert sorted(r["start_ts"] for r in tracestore.retain(spans, 20).collect()) == [20, 30, DAY + 5]


def test_sampling_keeps_traces_whole(spark):
    spans = spark.range(20_000).select((F.col("id") % 1000).alias("trace_id"), "id")
    kept = tracestore.sample_traces(spans, 0.3)
    sizes = {r["count"] for r in kept.groupBy("trace_id").count().collect()}
    assert sizes == {20}
    assert 200 < kept.select("trace_id").distinct().count() < 400
    assert tracestore.sample_traces(spans, 1.0).count() == 20_000
    assert tracestore.sample_traces(spans, 0.0).count() == 0


def test_trace_keys(spark):
    df = spark.createDataFrame([(0, 255), (1, -1)], "h BIGINT, l BIGINT")
    h, l = F.col("h"), F.col("l")
    assert [r[0] for r in df.select(trace_key_text(h, l)).collect()] == ["0" * 30 + "ff", "0" * 15 + "1" + "f" * 16]
    assert df.select(trace_key(h, l).alias("k")).first()["k"].trace_id == 255


def test_kinds(notes):
    assert tracestore.events_of(notes).count() == 3
    tags = rows(tracestore.span_tags(notes).where("trace_id = 1"), "span_id", "a_key", "a_value")
    assert tags == [(2, "http", "x"), (3, "http", "a"), (4, "none", "1"), (4, "size", "1")]
    maps = {(r["trace_id"], r["span_id"]): r["tags"] for r in tracestore.span_tag_maps(notes).collect()}
    assert maps[(1, 4)] == {"none": "1", "size": "1"}


def test_large_tag_maps_are_paged(spark):
    many = spark.createDataFrame([note(1, f"k{i}") for i in range(200)] + [note(2, "k")], struct_of("annotations"))
    pages = tracestore.span_tag_maps(many, page_size=20).collect()
    large = [p["tags"] for p in pages if p["span_id"] == 1]
    assert len(large) > 5 and sum(map(len, large)) == 200 and len({k for p in large for k in p}) == 200
    assert [p["page"] for p in pages if p["span_id"] == 2] == [0]


def test_point_counts(spark):
    points = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 20) AS time, 's' AS endpoint_service_name, "
        "1 AS a_number, id * 10 AS duration FROM range(6)"
    )
    counts = tracestore.point_counts(points, quantiles=(0.5,)).orderBy("window_start").collect()
    assert [(c["points"], c["mean_duration"], c["max_duration"], c["duration_p50"]) for c in counts] == [(3, 10.0, 20, 10), (3, 40.0, 50, 40)]
    assert tracestore.point_counts(points, "1 minute", "30 seconds").agg(F.sum("points")).first()[0] == 12


def test_days_outside_the_range_are_not_read(spark, spans, tmp_path):
    path = str(tmp_path / "by_day")
    write_by_day(spans.where("start_ts IS NOT NULL"), path, batch_id=0)
    stored = spark.read.parquet(path)
    assert stored.count() == 5 and {str(r[0]) for r in stored.select("day").distinct().collect()} == {"1970-01-01", "1970-01-02"}
    late = day_range(stored, DAY, DAY + 10)
    assert [r["id"] for r in late.collect()] == [4]
    assert "PartitionFilters: [isnotnull(day" in late._jdf.queryExecution().executedPlan().toString()
    write_by_day(spans.where(f"start_ts >= {DAY}"), path, batch_id=1)  # late rows join their day ...
    assert spark.read.parquet(path).count() == 6
    write_by_day(spans.where(f"start_ts >= {DAY}"), path, batch_id=1)  # ... and a batch again replaces itself
    assert spark.read.parquet(path).count() == 6


def test_expired_days_are_dropped(spark, spans, tmp_path):
    spark.sql(f"CREATE DATABASE traces LOCATION '{tmp_path}/traces'")
    for _ in range(2):
        write_day_table(spans, "traces.spans", batch_id=0)
    assert spark.table("traces.spans").count() == spans.count()
    assert expire_days(spark, "traces.spans", date(1970, 1, 2)) == [NO_DAY, date(1970, 1, 1)]
    assert [r["id"] for r in spark.table("traces.spans").collect()] == [4]
    assert expire_days(spark, "traces.spans", date(1970, 1, 2)) == []
    spark.sql("DROP DATABASE traces CASCADE")
