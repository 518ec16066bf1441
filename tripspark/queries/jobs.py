"""Whole jobs, run twice and read back from what they wrote, and operators over spans with several annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.operators import lists, spans, tracestore
from tripspark.plans.bookings import read_bookings, run_bookings
from tripspark.plans.trace_copy import copy_annotations, copy_spans
from tripspark.queries.bookings import FIXED_TIME
from tripspark.queries.registry import query
from tripspark.queries.traces import COPIED_ROWS
from tripspark.session import fresh_path, stage
from tripspark.sinks.tables import write_by_day, write_links
from tripspark.sources.analog import AnalogTables

# Several annotations per span


@query("SELECT trace_id_high, trace_id, span_id, a_key, a_timestamp FROM v_varied_annotations WHERE a_type = -1")
def span_events(t: AnalogTables) -> DataFrame:
    found = tracestore.events_of(t.varied_annotations())
    return found.select("trace_id_high", "trace_id", "span_id", "a_key", "a_timestamp")


@query("SELECT trace_id_high, trace_id, span_id, a_key, a_value, a_timestamp FROM v_varied_annotations WHERE NOT scanned")
def unprocessed_annotations(t: AnalogTables) -> DataFrame:
    """All annotations but those in the ledger, also where time is missing."""
    ledger = spans.annotation_ledger(t.varied_annotations().where("scanned"))
    new = spans.unprocessed_annotations(t.varied_annotations(), ledger)
    return new.select("trace_id_high", "trace_id", "span_id", "a_key", "a_value", "a_timestamp")


@query("""
SELECT trace_id, span_id, a_key, a_value, a_timestamp FROM v_varied_annotations WHERE a_timestamp IS NOT NULL AND NOT scanned
UNION ALL
SELECT trace_id, span_id, a_key, a_value, a_timestamp FROM v_varied_annotations, range(2) WHERE a_timestamp IS NULL""")
def insert_ignore_annotations(t: AnalogTables) -> DataFrame:
    """All annotations arrive, sent twice; scanned ones are stored. A missing time equals nothing, so those all stay."""
    new = stage(t.varied_annotations(), "new-annotations")
    stored = t.varied_annotations().where("scanned")
    kept = tracestore.insert_ignore(new.unionByName(new), stored, tracestore.ANNOTATION_KEY)
    return kept.select("trace_id", "span_id", "a_key", "a_value", "a_timestamp")


@query(f"SELECT {COPIED_ROWS} FROM v_varied_joined")
def span_rows_both_halves(t: AnalogTables) -> DataFrame:
    return spans.span_rows(t.varied_spans(), t.varied_annotations(), use_high=True)


@query("""
SELECT * EXCLUDE (place) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY time_us ORDER BY trace_id DESC, span_id DESC, a_key DESC, a_value DESC) AS place
  FROM v_varied_points) WHERE place = 1""")
def varied_points_last_write(t: AnalogTables) -> DataFrame:
    """Many points share a minute, so most are overwritten."""
    rows = spans.span_rows(t.varied_spans(), t.varied_annotations(), use_high=True)
    return spans.last_write_wins(spans.to_points(rows))


@query("""
SELECT date_trunc('minute', time) AS window_start, endpoint_service_name AS service, CAST(SUM(a_number) AS BIGINT) AS points,
       ROUND(CAST(SUM(duration) AS DOUBLE) / COUNT(duration), 4) AS mean_duration, MAX(duration) AS max_duration
FROM v_varied_points GROUP BY ALL""")
def varied_counts_per_minute(t: AnalogTables) -> DataFrame:
    rows = spans.span_rows(t.varied_spans(), t.varied_annotations(), use_high=True)
    counts = tracestore.point_counts(spans.to_points(rows))
    return counts.withColumn("mean_duration", F.round("mean_duration", 4))


@query("""
SELECT trace_id, (place - 1) // 5 AS page, string_agg(name, ',' ORDER BY name) AS names
FROM (SELECT trace_id, name, ROW_NUMBER() OVER (PARTITION BY trace_id ORDER BY name) AS place FROM v_varied_spans)
GROUP BY ALL""")
def span_names_in_pages(t: AnalogTables) -> DataFrame:
    """Names of a trace's spans in pages of five; most names repeat."""
    found = lists.pages(t.varied_spans(), ["trace_id"], ["name"], "names", page_size=5)
    return found.withColumn("names", F.array_join("names", ","))


@query("""
SELECT trace_id, (place - 1) // 5 AS page, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids
FROM (SELECT trace_id, id, ROW_NUMBER() OVER (PARTITION BY trace_id ORDER BY id) AS place FROM v_varied_spans)
GROUP BY ALL""")
def span_ids_in_pages(t: AnalogTables) -> DataFrame:
    found = lists.pages(t.varied_spans(), ["trace_id"], ["id"], "ids", page_size=5, distinct=True)
    return found.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


# Jobs


@query("""
SELECT ROW_NUMBER() OVER (ORDER BY request_id % 2, request_id) AS id, service_provider, route_id, booking_time
FROM v_results WHERE status = 'booked'""")
def booking_job(t: AnalogTables) -> DataFrame:
    """Even requests in one run, all in the next, and the next once more, as after a crash."""
    path, requests, routes = fresh_path(t.spark, "booking-job"), t.booking_requests(), t.stored_routes()
    run_bookings(requests.where("request_id % 2 = 0"), routes, path, 0, F.expr(FIXED_TIME))
    for _ in range(2):
        run_bookings(requests, routes, path, 1, F.expr(FIXED_TIME))
    return read_bookings(t.spark, path)


def lines_of(points: str) -> str:
    """SQL for the text lines of span points."""
    return f"""
SELECT 'zipkin_spans trace_id=' || trace_id || 'i,span_id=' || span_id || 'i,parent_id=' || parent_id || 'i,name="' || name
  || '",endpoint_service_name="' || endpoint_service_name || '",endpoint_port=' || endpoint_port || 'i,a_key="' || a_key
  || '",a_value="' || a_value || '",a_type=' || a_type || 'i,endpoint_ipv4=' || endpoint_ipv4 || 'i,endpoint_ipv6="'
  || endpoint_ipv6 || '",start_ts=' || start_ts || 'i,duration=' || duration || 'i,a_number=1i ' || time_us * 1000 AS value
FROM {points}"""


@query(lines_of("v_varied_points"))
def span_copy_job(t: AnalogTables) -> DataFrame:
    """Copies spans twice; the second run finds all of them in the ledger."""
    points, ledger = fresh_path(t.spark, "span-lines"), fresh_path(t.spark, "span-ledger")
    copy_spans(t.varied_spans(), t.varied_annotations(), points, ledger, use_high=True)
    copied = t.spark.read.parquet(ledger)
    copy_spans(t.varied_spans(), t.varied_annotations(), points, ledger, copied, use_high=True)
    return t.spark.read.text(points)


@query("""
SELECT 'zipkin_annotations trace_id=' || trace_id || 'i,span_id=' || span_id || 'i,a_key="' || a_key || '",a_value="' || a_value
  || '",a_type=' || a_type || 'i,endpoint_ipv4=' || endpoint_ipv4 || 'i,endpoint_ipv6="",endpoint_port=' || endpoint_port
  || 'i,endpoint_service_name="' || endpoint_service_name || '" ' || a_timestamp * 1000 AS value
FROM v_varied_annotations WHERE NOT scanned AND a_timestamp IS NOT NULL""")
def annotation_copy_job(t: AnalogTables) -> DataFrame:
    points, ledger = fresh_path(t.spark, "annotation-lines"), fresh_path(t.spark, "annotation-ledger")
    copy_annotations(t.varied_annotations(), points, ledger)
    stored = t.spark.read.parquet(ledger)
    copy_annotations(t.varied_annotations(), points, ledger, stored)
    return t.spark.read.text(points)


@query("""
SELECT trace_id, id, start_ts, COALESCE(CAST(make_timestamp(start_ts) AS DATE), DATE '0001-01-01') AS day
FROM v_varied_spans""")
def spans_by_day(t: AnalogTables) -> DataFrame:
    """Odd spans join the days that the even ones made, and are written a second time."""
    path, rows = fresh_path(t.spark, "spans-by-day"), t.varied_spans()
    write_by_day(rows.where("id % 2 = 0"), path, batch_id=0)
    for _ in range(2):
        write_by_day(rows.where("id % 2 = 1"), path, batch_id=1)
    return t.spark.read.parquet(path).select("trace_id", "id", "start_ts", "day")


@query("SELECT day, parent, child, COUNT(*) AS call_count FROM v_links GROUP BY day, parent, child")
def stored_daily_links(t: AnalogTables) -> DataFrame:
    """Written twice: a day counted again replaces itself, so (day, parent, child) stays unique."""
    path, links = fresh_path(t.spark, "daily-links"), stage(tracestore.dependency_links(t.spans(), t.annotations()), "links")
    for _ in range(2):
        write_links(links, path)
    return t.spark.read.parquet(path).select("day", "parent", "child", "call_count")
