"""Streams run until done, several times on one checkpoint, against batch answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_spans import note, span
from tripspark.operators.booking import book
from tripspark.operators.spans import span_rows, to_points
from tripspark.operators.tracestore import ANNOTATION_KEY, dependency_links, point_counts, with_service
from tripspark.schemas import BOOKING_REQUESTS, struct_of
from tripspark.sources.daystore import DayStore
from tripspark.streaming import bookings, copy, traces
from tripspark.streaming.files import UNTIL_DONE, file_stream

SEC = 1_000_000
T0 = 1_704_067_200 * SEC  # 2024-01-01


class Feed:
    """A folder that grows between runs, read as a stream."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema
        spark.createDataFrame([], schema).write.parquet(self.path)

    def add(self, *records):
        self.spark.createDataFrame(list(records), self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return file_stream(self.spark, self.path, self.schema)


@pytest.fixture
def feeds(spark, tmp_path):
    def feed(name, schema):
        return Feed(spark, tmp_path / name, schema)

    return feed


def test_copy_with_late_annotations(spark, feeds, tmp_path):
    spans, notes = feeds("spans", struct_of("spans")), feeds("notes", struct_of("annotations"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        copy.start_copy(spans.stream(), notes.stream(), out, checkpoint, UNTIL_DONE).awaitTermination()

    def copied(id):
        return sorted(r["a_key"] for r in spark.read.parquet(f"{out}/points/rows").where(f"span_id = {id}").collect())

    spans.add(span(1, start=T0), span(2, start=T0 + SEC), span(3, start=T0 + 2 * SEC))
    notes.add(note(1, "now", time=T0 + 5))
    run()
    assert copied(1) == ["now"] and copied(2) == [] and copied(3) == []

    notes.add(note(2, "late", time=T0 + 3 * SEC))
    run()
    assert copied(2) == ["late"]

    far = T0 + 3600 * SEC
    spans.add(span(90, start=far))
    notes.add(note(91, time=far))
    run()
    assert copied(3) == [""]  # nothing can match any more

    notes.add(note(3, "too late", time=T0 + 4 * SEC), note(2, "too late", time=T0 + 4 * SEC))
    run()
    assert copied(2) == ["late"] and copied(3) == [""]
    assert spark.read.text(f"{out}/lines").count() == 3


def test_batch_written_again_replaces_itself(spark, tmp_path):
    row = spark.createDataFrame(
        [(1, 1, None, "n", "s", 1, "k", "v", 6, None, None, T0, T0, 5, False)],
        "trace_id BIGINT, span_id BIGINT, parent_id BIGINT, name STRING, endpoint_service_name STRING, endpoint_port INT, "
        "a_key STRING, a_value STRING, a_type INT, endpoint_ipv4 INT, endpoint_ipv6 STRING, start_ts BIGINT, "
        "a_timestamp BIGINT, duration BIGINT, alone BOOLEAN",
    )
    for batch in (0, 1, 1):
        copy.write_copy_batch(row, batch, str(tmp_path))
    assert copy.read_points(spark, str(tmp_path)).count() == 2
    assert spark.read.text(f"{tmp_path}/lines").count() == 2


def test_booking_stream(spark, feeds, routes, tmp_path):
    schema = BOOKING_REQUESTS + ", requested_at TIMESTAMP"
    asked = feeds("asked", schema)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    first = [(1, "drive-now", 1), (2, "deutsche-bahn", 8), (3, "drive-now", 8), (4, "drivenow", 1)]
    second = [(5, "drive-now", 2), (6, None, 2)]
    moment = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' AS t").first()[0]

    def send(requests):
        asked.add(*[(*r, moment) for r in requests])
        bookings.start_bookings(
            asked.stream(), routes, out, checkpoint, UNTIL_DONE, now=F.expr("TIMESTAMP_NTZ'2024-02-01 12:00:00'")
        ).awaitTermination()

    send(first + first)
    send(second + first[:2])  # two requests are sent again
    results = spark.read.parquet(f"{out}/results").drop("batch_id")
    batch = book(spark.createDataFrame(first + second, BOOKING_REQUESTS), routes, F.expr("TIMESTAMP_NTZ'2024-02-01 12:00:00'"))
    assert rows(results) == rows(batch)
    booked = rows(spark.read.parquet(f"{out}/booked"), "id", "service_provider", "route_id")
    assert booked == [(1, "drivenow", 1), (2, "deutschebahn", 8), (3, "drivenow", 2)]


def test_booking_batch_again_gets_the_same_keys(spark, routes, tmp_path):
    for batch, ids in ((0, [1, 2]), (1, [3, 4]), (1, [3, 4])):
        asked = spark.createDataFrame([(i, "drive-now", i) for i in ids], BOOKING_REQUESTS)
        bookings.write_booking_batch(asked, batch, routes, str(tmp_path))
    assert [r[0] for r in rows(spark.read.parquet(f"{tmp_path}/booked"), "id")] == [1, 2, 3, 4]


def _run(stream, out, checkpoint):
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(**UNTIL_DONE)
    writer.format("parquet").option("path", out).start().awaitTermination()


def test_first_of_key(spark, feeds, tmp_path):
    notes = feeds("notes", struct_of("annotations"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):
        notes.add(note(1, time=T0), note(1, time=T0), note(1, "other", time=T0), note(1, time=None), note(1, time=None))
        _run(traces.first_of_key(notes.stream(), ANNOTATION_KEY, "a_timestamp"), out, checkpoint)
    found = spark.read.parquet(out)
    assert found.where("a_timestamp IS NOT NULL").count() == 2
    assert found.where("a_timestamp IS NULL").count() == 4


POINT = "time TIMESTAMP, endpoint_service_name STRING, a_number INT, duration BIGINT"


def test_window_counts(spark, feeds, tmp_path):
    points = feeds("points", POINT)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    base = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' AS t").first()[0]
    from datetime import timedelta

    early = [(base + timedelta(seconds=20 * i), "s", 1, i) for i in range(6)]
    for batch in (early[:3], early[3:], [(base + timedelta(days=1), "s", 1, 0)]):
        points.add(*batch)
        _run(traces.stream_point_counts(points.stream()), out, checkpoint)
    expected = point_counts(spark.createDataFrame(early, POINT))
    assert rows(spark.read.parquet(out), *expected.columns) == rows(expected)
    points.add((base, "s", 1, 0))  # its window is closed
    _run(traces.stream_point_counts(points.stream()), out, checkpoint)
    assert rows(spark.read.parquet(out), *expected.columns) == rows(expected)


def stored(spark, path, name, time, batches):
    store = DayStore(spark, str(path), struct_of(name), time)
    for number, records in enumerate(batches):
        store.write(spark.createDataFrame(records, struct_of(name)), number)
    return store


def test_links_across_batches(spark, feeds, tmp_path):
    schema = struct_of("spans").add("service", "string")
    feed = feeds("spans", schema)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    named = [
        (*span(1, start=T0), "a"), (*span(2, parent=1, start=T0 + SEC), "b"), (*span(3, parent=1, start=T0 + 2 * SEC), "a"),
        (*span(4, parent=2, start=T0 + 3 * SEC), "a"), (*span(5, parent=2, start=T0 + 4 * SEC), None),
        (*span(6, parent=1, start=T0 + 5 * SEC), "b"),
    ]
    end = (*span(90, trace=9, start=T0 + 86_400 * SEC), "z")
    for part in (named[1:2], named[:1], named[2:], [end]):  # a child comes before its parent
        feed.add(*part)
        traces.start_links(feed.stream(), out, checkpoint, UNTIL_DONE).awaitTermination()
    assert rows(traces.read_links(spark, out), "parent", "child", "call_count") == [("a", "b", 2), ("b", "a", 1)]
    spans = spark.createDataFrame([n[:-1] for n in named], struct_of("spans"))
    notes = spark.createDataFrame([note(n[2], service=n[-1]) for n in named], struct_of("annotations"))
    assert rows(dependency_links(spans, notes)) == rows(traces.read_links(spark, out))
    assert with_service(spans, notes).where("service IS NULL").count() == 1


def test_settled_links_follow_what_comes_late(spark, tmp_path):
    """A child a day after its parent, a parent after its child, and a service that is known later."""
    day = 86_400 * SEC
    spans = [
        [span(1, start=T0), span(2, parent=1, start=T0 + day), span(4, parent=3, start=T0 + day)],
        [span(3, start=T0), span(5, parent=1, start=T0 + 2 * day)],
        [],
    ]
    notes = [[note(1, service="a", time=T0), note(2, service="b", time=T0)], [note(4, service="b", time=T0), note(5, service="a", time=T0)],
             [note(3, service="c", time=T0), note(5, service="d", time=T0 - 1)]]
    rows_, noted = stored(spark, tmp_path / "s", "spans", "start_ts", []), stored(spark, tmp_path / "n", "annotations", "a_timestamp", [])
    out = str(tmp_path / "out")
    for k in range(3):
        for store, name, batches in ((rows_, "spans", spans), (noted, "annotations", notes)):
            store.write(spark.createDataFrame(batches[k], struct_of(name)), k)
        assert traces.settle_links(rows_, noted, out) > 0 and traces.settle_links(rows_, noted, out) == 0
        whole = dependency_links(rows_.rows(), noted.rows())
        assert rows(traces.read_links(spark, out), "day", "parent", "child", "call_count") == rows(whole, "day", "parent", "child", "call_count")
    assert whole.count() == 3


def test_settling_sends_what_the_stream_left_out(spark, feeds, tmp_path):
    spans, notes = feeds("spans", struct_of("spans")), feeds("notes", struct_of("annotations"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    far = T0 + 3600 * SEC
    started = [span(1, start=T0), span(2, start=T0 + SEC), span(3, start=None), span(4, start=T0), span(90, trace=2, start=far)]
    noted = [note(1, "now", time=T0 + 5), note(91, trace=2, time=far)]
    late = [note(2, "late", time=T0 + 600 * SEC), note(3, "", value=b"", time=T0, service=""), note(1, "early", time=T0 - 60 * SEC)]
    spans.add(*started)
    notes.add(*noted)
    copy.start_copy(spans.stream(), notes.stream(), out, checkpoint, UNTIL_DONE).awaitTermination()
    rows_ = stored(spark, tmp_path / "s", "spans", "start_ts", [started])
    stored_notes = stored(spark, tmp_path / "n", "annotations", "a_timestamp", [noted])

    def settled():
        days = copy.settle_copy(rows_, stored_notes, out)
        whole = to_points(span_rows(rows_.rows(), stored_notes.rows()))
        assert rows(copy.read_points(spark, out), *whole.columns) == rows(whole, *whole.columns)
        return days

    assert settled() > 0 and copy.settle_copy(rows_, stored_notes, out) == 0
    stored_notes.write(spark.createDataFrame(late, struct_of("annotations")), 1)
    assert settled() == 2 and settled() == 0  # the days of the late annotations, no other


def test_trigger_is_five_seconds_by_default(spark, feeds):
    class Recorder:
        def trigger(self, **kwargs):
            return kwargs

    from tripspark.streaming.files import with_trigger

    assert with_trigger(Recorder(), None) == {"processingTime": "5 seconds"}
    assert with_trigger(Recorder(), UNTIL_DONE) == {"availableNow": True}
