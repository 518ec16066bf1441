from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripspark.operators.spans import (
    annotation_ledger, annotation_points, last_write_wins, span_ledger, span_rows, to_points, unprocessed_annotations,
    unprocessed_spans, unscanned, with_tag,
)
from tripspark.operators.tracestore import ANNOTATION_KEY, insert_ignore
from tripspark.operators.spans import SPAN_KEY
from tripspark.plans.trace_copy import copy_annotations, copy_spans
from tripspark.schemas import struct_of
from tripspark.sinks.points import to_line_protocol

V6 = bytes(range(16))


def span(id, trace=1, high=0, name="get", parent=None, start=1_000_000, duration=500, scanned=False):
    return (high, trace, id, name, parent, None, start, duration, scanned)


def note(span_id, key="k", value=b"v", time=1_000_001, trace=1, high=0, kind=6, v6=None, port=80, service="svc", scanned=False):
    return (high, trace, span_id, key, value, kind, time, None, v6, port, service, scanned)


SPANS = [
    span(10),  # no annotation
    span(11),  # three annotations
    span(12, scanned=True),
    span(13, scanned=None),
    span(15),  # two annotations at one time
    span(16),  # annotation without time
    span(17),  # port above 32767 and an address
    span(18),  # annotation without texts
    span(20, trace=2),
    span(20, trace=2, high=7),  # same low id
]
NOTES = [
    note(11, "a", time=1), note(11, "b", time=2), note(11, "c", time=3),
    note(12), note(13),
    note(15, "a", time=900), note(15, "b", time=900),
    note(16, time=None),
    note(17, v6=V6, port=-25536, time=17),
    note(18, value=None, service=None, time=18),
    note(20, trace=2, time=20),
]


@pytest.fixture(scope="module")
def spans(spark):
    return spark.createDataFrame(SPANS, struct_of("spans"))


@pytest.fixture(scope="module")
def notes(spark):
    return spark.createDataFrame(NOTES, struct_of("annotations"))


def test_unscanned(spans):
    assert unscanned(spans).where("id IN (12, 13)").count() == 0


def test_left_join(spans, notes):
    joined = span_rows(spans, notes)
    assert joined.count() == 1 + 3 + 2 + 1 + 1 + 1 + 2
    assert rows(joined.where("span_id = 10"), "a_key") == [(None,)]
    parity = span_rows(spans, notes, parity=True)
    assert rows(parity.where("a_key IS NULL"), "span_id") == [(None,)]
    assert joined.where("trace_id = 2").count() == 2
    high = span_rows(spans, notes, use_high=True).where("trace_id = 2")
    assert sorted(rows(high, "a_key"), key=str) == [("k",), (None,)]


def test_left_join_with_heavy_span(spark, spans, notes, force_hot):
    many = spark.createDataFrame([note(11, f"k{i % 5}", time=i) for i in range(500)], struct_of("annotations"))
    joined = span_rows(spans, many.union(notes.where("span_id <> 11")))
    assert joined.where("span_id = 11").count() == 500
    assert joined.where("span_id = 11").distinct().count() == 500
    assert joined.where("span_id <> 11").count() == 8
    assert rows(joined.where("span_id = 10"), "a_key") == [(None,)]


def test_values_readable(spans, notes):
    row = span_rows(spans, notes).where("span_id = 17").first()
    assert (row["endpoint_port"], row["endpoint_ipv6"], row["a_value"]) == (40000, V6.hex(), "v")
    empty = span_rows(spans, notes).where("span_id = 18").first()
    assert empty["a_value"] is None and empty["endpoint_service_name"] is None


def test_points(spans, notes):
    points = to_points(span_rows(spans, notes))
    empty = points.where("span_id = 18").first()
    assert (empty["a_value"], empty["endpoint_service_name"], empty["parent_id"], empty["a_number"]) == ("", "", 0, 1)
    assert points.where("span_id = 16").first()["time_us"] == 1_000_000
    parity = to_points(span_rows(spans, notes, parity=True), parity=True)
    assert parity.where("span_id = 16").first()["time"].year == 1970
    assert parity.where("a_key = ''").first()["span_id"] == 0
    timeless = to_points(span_rows(spans, notes).withColumn("start_ts", F.lit(None).cast("bigint")))
    assert timeless.where("span_id IN (10, 16)").count() == 0


def test_last_write_wins(spans, notes):
    points = to_points(span_rows(spans, notes))
    assert points.where("time_us = 900").count() == 2
    kept = last_write_wins(points)
    assert rows(kept.where("time_us = 900"), "a_key") == [("b",)]
    assert kept.columns == points.columns
    assert kept.count() == points.select("time_us").distinct().count()


def test_lines(spark):
    points = spark.createDataFrame(
        [(1_000_001, "a\"b\\c\nd", 5, None)], "time_us BIGINT, `name one` STRING, n INT, none STRING"
    )
    assert to_line_protocol(points, "m x").first()[0] == 'm\\ x name\\ one="a\\"b\\\\c\\nd",n=5i 1000001000'


def test_ledgers(spans, notes):
    ledger = span_ledger(unscanned(spans))
    assert ledger.where("id = 11").count() == 1
    assert sorted(r["id"] for r in unprocessed_spans(spans, ledger).collect()) == [12, 13]
    marked = annotation_ledger(notes.where("span_id IN (16, 18)"))
    left = unprocessed_annotations(notes, marked)
    assert left.count() == len(NOTES) - 2 and left.columns == notes.columns


def test_ledger_with_heavy_copies(notes, force_hot):
    copies = notes
    for _ in range(5):
        copies = copies.union(notes.where("span_id = 16"))
    assert unprocessed_annotations(copies, annotation_ledger(notes.where("span_id = 16"))).count() == len(NOTES) - 1


def test_copy_runs_once_per_span(spark, spans, notes, tmp_path):
    points, ledger = str(tmp_path / "points"), str(tmp_path / "ledger")
    copy_spans(spans, notes, points, ledger)
    lines = spark.read.text(points)
    assert lines.count() == 11 and lines.where("value LIKE 'zipkin_spans %'").count() == 11
    stored = spark.read.parquet(ledger)
    assert stored.count() == 8
    copy_spans(spans, notes, points, ledger, stored)
    assert spark.read.text(points).count() == 11


def test_copy_of_annotations(spark, notes, tmp_path):
    points, ledger = str(tmp_path / "points"), str(tmp_path / "ledger")
    copy_annotations(notes, points, ledger)
    assert spark.read.text(points).count() == len(NOTES) - 1
    copy_annotations(notes, points, ledger, spark.read.parquet(ledger))
    assert spark.read.text(points).count() == len(NOTES) - 1
    assert annotation_points(notes, parity=True).count() == len(NOTES)


def test_with_tag(spans):
    tagged = with_tag(spans, "usersession", F.when(F.col("id") == 10, "s1"))
    assert rows(tagged, "span_id", "a_key", "a_value", "a_type") == [(10, "usersession", "s1", 6)]


def test_insert_ignore(spark, spans, notes):
    twice = spans.union(spans)
    assert insert_ignore(twice, spans.limit(0), SPAN_KEY).count() == len(SPANS)
    assert insert_ignore(twice, spans.where("id = 10"), SPAN_KEY).count() == len(SPANS) - 1
    smaller = spark.createDataFrame([span(10, name="b"), span(10, name="a")], struct_of("spans"))
    assert rows(insert_ignore(smaller, spans.limit(0), SPAN_KEY), "name") == [("a",)]
    doubled = notes.union(notes)
    kept = insert_ignore(doubled, notes.limit(0), ANNOTATION_KEY)
    assert kept.count() == len(NOTES) + 1  # the two without time are both kept
    assert kept.columns == notes.columns


def test_insert_ignore_without_case(spark, notes):
    new = spark.createDataFrame([note(1, "Key"), note(1, "key"), note(2, "KEY")], struct_of("annotations"))
    stored = spark.createDataFrame([note(2, "key")], struct_of("annotations"))
    assert insert_ignore(new, stored, ANNOTATION_KEY).count() == 3
    assert rows(insert_ignore(new, stored, ANNOTATION_KEY, ignore_case=True), "a_key") == [("Key",)]
