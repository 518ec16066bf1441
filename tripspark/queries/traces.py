"""Spans, points and the trace store."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.functions.traces import trace_key_text
from tripspark.operators import spans, tracestore
from tripspark.plans.catalogue import catalogue_of
from tripspark.queries.registry import query
from tripspark.session import stage
from tripspark.sinks.points import to_line_protocol
from tripspark.sources.analog import AnalogTables
from tripspark.vocabulary import ANNOTATION_MEASUREMENT, SPAN_MEASUREMENT

COPIED_ROWS = ", ".join(spans.ROW_COLUMNS)


def micros(year: int, month: int, day: int) -> int:
    return int(datetime(year, month, day, tzinfo=UTC).timestamp()) * 1_000_000


# Copy to points


@query("SELECT * FROM v_spans WHERE NOT scanned")
def unscanned_spans(t: AnalogTables) -> DataFrame:
    return spans.unscanned(t.spans())


@query("SELECT * FROM v_spans WHERE NOT scanned")
def unprocessed_spans(t: AnalogTables) -> DataFrame:
    """All spans but those in the ledger, which holds the scanned ones."""
    stored = t.spans()
    ledger = spans.span_ledger(t.spans(parents=False).where("scanned"))
    return spans.unprocessed_spans(stored, ledger)


@query(f"SELECT {COPIED_ROWS} FROM v_joined")
def span_annotation_left_join(t: AnalogTables) -> DataFrame:
    return spans.span_rows(t.spans(), t.annotations(), parity=True)


@query(f"SELECT {COPIED_ROWS} FROM (SELECT * REPLACE (COALESCE(span_id, id) AS span_id) FROM v_joined)")
def span_rows(t: AnalogTables) -> DataFrame:
    return spans.span_rows(t.spans(), t.annotations())


@query("SELECT * FROM v_points")
def span_points(t: AnalogTables) -> DataFrame:
    return spans.to_points(spans.span_rows(t.spans(), t.annotations()))


@query("""
SELECT time_us, make_timestamp(time_us) AS time, * EXCLUDE (time_us, a_timestamp, id, start_ts, rest), start_ts, 1 AS a_number
FROM (SELECT COALESCE(a_timestamp, 0) AS time_us, trace_id, COALESCE(span_id, 0) AS span_id,
        COALESCE(parent_id, 0) AS parent_id, name, COALESCE(endpoint_service_name, '') AS endpoint_service_name,
        COALESCE(endpoint_port, 0) AS endpoint_port, COALESCE(a_key, '') AS a_key, COALESCE(a_value, '') AS a_value,
        COALESCE(a_type, 0) AS a_type, COALESCE(endpoint_ipv4, 0) AS endpoint_ipv4,
        COALESCE(endpoint_ipv6, '') AS endpoint_ipv6, start_ts, COALESCE(duration, 0) AS duration,
        a_timestamp, id, 0 AS rest FROM v_joined)""")
def span_points_parity(t: AnalogTables) -> DataFrame:
    """Missing ids and times become 0, so spans without annotations land on 1970-01-01."""
    return spans.to_points(spans.span_rows(t.spans(), t.annotations(), parity=True), parity=True)


@query("""
SELECT * EXCLUDE (place) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY time_us ORDER BY trace_id DESC, span_id DESC, a_key DESC, a_value DESC) AS place
  FROM v_points) WHERE place = 1""")
def span_points_last_write(t: AnalogTables) -> DataFrame:
    return spans.last_write_wins(spans.to_points(spans.span_rows(t.spans(), t.annotations())))


@query("""
SELECT 'zipkin_spans trace_id=' || trace_id || 'i,span_id=' || span_id || 'i,parent_id=' || parent_id || 'i,name="' || name
  || '",endpoint_service_name="' || endpoint_service_name || '",endpoint_port=' || endpoint_port || 'i,a_key="' || a_key
  || '",a_value="' || a_value || '",a_type=' || a_type || 'i,endpoint_ipv4=' || endpoint_ipv4 || 'i,endpoint_ipv6="'
  || endpoint_ipv6 || '",start_ts=' || start_ts || 'i,duration=' || duration || 'i,a_number=1i ' || time_us * 1000 AS value
FROM v_points""")
def span_lines(t: AnalogTables) -> DataFrame:
    return to_line_protocol(spans.to_points(spans.span_rows(t.spans(), t.annotations())), SPAN_MEASUREMENT)


ANNOTATION_POINTS = """
SELECT a_timestamp AS time_us, make_timestamp(a_timestamp) AS time, trace_id, span_id, a_key, COALESCE(a_value, '') AS a_value,
       a_type, 0 AS endpoint_ipv4, '' AS endpoint_ipv6, 0 AS endpoint_port, endpoint_service_name FROM v_annotations"""


@query(ANNOTATION_POINTS)
def annotation_points(t: AnalogTables) -> DataFrame:
    return spans.annotation_points(t.annotations())


@query(f"""
SELECT 'zipkin_annotations trace_id=' || trace_id || 'i,span_id=' || span_id || 'i,a_key="' || a_key || '",a_value="' || a_value
  || '",a_type=' || a_type || 'i,endpoint_ipv4=0i,endpoint_ipv6="",endpoint_port=0i,endpoint_service_name="'
  || endpoint_service_name || '" ' || time_us * 1000 AS value FROM ({ANNOTATION_POINTS} )""")
def annotation_lines(t: AnalogTables) -> DataFrame:
    return to_line_protocol(spans.annotation_points(t.annotations()), ANNOTATION_MEASUREMENT)


@query("""
SELECT trace_id_high, trace_id, id AS span_id, 'usersession' AS a_key, 'session-' || trace_id AS a_value, 6 AS a_type,
       start_ts AS a_timestamp FROM v_spans""")
def tagged_spans(t: AnalogTables) -> DataFrame:
    session = F.concat(F.lit("session-"), F.col("trace_id").cast("string"))
    return spans.with_tag(t.spans(parents=False), "usersession", session)


# Names and services


@query("""
SELECT DISTINCT endpoint_service_name AS service_name, endpoint_service_name || '/routes' AS url
FROM v_annotations WHERE endpoint_service_name LIKE '%mobility-service'""")
def service_catalogue(t: AnalogTables) -> DataFrame:
    return catalogue_of(t.annotations())


@query("SELECT DISTINCT endpoint_service_name AS service_name FROM v_annotations")
def service_names(t: AnalogTables) -> DataFrame:
    return tracestore.service_names(t.annotations())


@query("SELECT DISTINCT name FROM v_spans")
def span_names(t: AnalogTables) -> DataFrame:
    return tracestore.span_names(t.spans(parents=False))


@query("""
SELECT DISTINCT v.service AS service_name, s.name
FROM v_spans s JOIN v_services v ON s.trace_id = v.trace_id AND s.id = v.id""")
def span_names_of_services(t: AnalogTables) -> DataFrame:
    return tracestore.span_names_of_services(t.spans(parents=False), t.annotations())


# Finding traces


@query("""
SELECT s.*, 0 AS page,
       CASE WHEN a.span_id IS NULL THEN '[]' ELSE CAST(to_json([{'a_timestamp': a.a_timestamp, 'a_key': a.a_key,
         'a_value': a.a_value, 'a_type': a.a_type, 'endpoint_service_name': a.endpoint_service_name}]) AS VARCHAR) END
         AS annotations
FROM v_spans s LEFT JOIN v_annotations a ON s.trace_id = a.trace_id AND s.id = a.span_id
WHERE s.trace_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def traces_by_ids(t: AnalogTables) -> DataFrame:
    """Spans, with nested annotations, of the traces numbered like customers in debt."""
    ids = t.table("customer").where(F.col("c_acctbal") < 0).select(
        F.lit(0).cast("bigint").alias("trace_id_high"), F.col("c_custkey").alias("trace_id")
    )
    found, notes = tracestore.traces_by_ids(t.spans(), ids), tracestore.traces_by_ids(t.annotations(), ids)
    nested = tracestore.with_annotation_pages(found, notes)
    return nested.withColumn("annotations", F.to_json("annotations", {"ignoreNullFields": "false"}))


@query(f"""
SELECT * FROM v_spans WHERE trace_id IN (
  SELECT s.trace_id FROM v_spans s
  JOIN v_annotations a ON s.trace_id = a.trace_id AND s.id = a.span_id
  JOIN v_services v ON s.trace_id = v.trace_id AND s.id = v.id
  WHERE s.name = 'error' AND v.service = 'svc-3-mobility-service' AND a.a_key = 'k' AND a.a_type = 6
    AND s.start_ts BETWEEN {micros(2024, 1, 8)} AND {micros(2024, 1, 22)} AND s.duration BETWEEN 20000 AND 200000)""")
def find_traces(t: AnalogTables) -> DataFrame:
    return tracestore.find_traces(
        t.spans(), t.annotations(), name="error", service="svc-3-mobility-service", key="k", a_type=6,
        start=micros(2024, 1, 8), end=micros(2024, 1, 22), min_duration=20_000, max_duration=200_000,
    )


@query("""
SELECT * FROM v_spans WHERE trace_id IN (SELECT trace_id FROM v_spans WHERE duration BETWEEN 250000 AND 400000)""")
def traces_by_duration(t: AnalogTables) -> DataFrame:
    return tracestore.find_traces(t.spans(), t.annotations(), min_duration=250_000, max_duration=400_000)


@query("""
SELECT trace_id_high, trace_id, MIN(start_ts) AS start_ts, COUNT(*) AS spans FROM v_spans
GROUP BY trace_id_high, trace_id ORDER BY start_ts DESC, trace_id""")
def traces_ordered(t: AnalogTables) -> DataFrame:
    return tracestore.traces_by_start(t.spans(parents=False))


@query("""
SELECT DISTINCT trace_id_high, trace_id,
       lower(lpad(hex(trace_id_high), 16, '0') || lpad(hex(trace_id), 16, '0')) AS trace_key FROM v_spans""")
def trace_keys(t: AnalogTables) -> DataFrame:
    high, low = F.col("trace_id_high"), F.col("trace_id")
    traces = t.spans(parents=False).select(high, low).distinct()
    return traces.withColumn("trace_key", trace_key_text(high, low))


# Links and counts


@query("SELECT day, parent, child, COUNT(*) AS call_count FROM v_links GROUP BY day, parent, child")
def dependency_links(t: AnalogTables) -> DataFrame:
    return tracestore.dependency_links(t.spans(), t.annotations())


@query("""
SELECT date_trunc('minute', time) AS window_start, endpoint_service_name AS service,
       CAST(SUM(a_number) AS BIGINT) AS points,
       ROUND(CAST(SUM(duration) AS DOUBLE) / COUNT(duration), 4) AS mean_duration, MAX(duration) AS max_duration
FROM v_points GROUP BY ALL""")
def point_counts_per_minute(t: AnalogTables) -> DataFrame:
    points = spans.to_points(spans.span_rows(t.spans(parents=False), t.annotations()))
    return tracestore.point_counts(points).withColumn("mean_duration", F.round("mean_duration", 4))


@query("""
SELECT w AS window_start, endpoint_service_name AS service, CAST(SUM(a_number) AS BIGINT) AS points,
       ROUND(CAST(SUM(duration) AS DOUBLE) / COUNT(duration), 4) AS mean_duration, MAX(duration) AS max_duration
FROM (SELECT *, UNNEST([time_bucket(INTERVAL 30 MINUTE, time), time_bucket(INTERVAL 30 MINUTE, time) - INTERVAL 30 MINUTE]) AS w
      FROM v_points) GROUP BY ALL""")
def point_counts_sliding(t: AnalogTables) -> DataFrame:
    """Windows of one hour, a new one every half hour."""
    points = spans.to_points(spans.span_rows(t.spans(parents=False), t.annotations()))
    return tracestore.point_counts(points, "1 hour", "30 minutes").withColumn(
        "mean_duration", F.round("mean_duration", 4)
    )


# Keeping and dropping rows


@query(f"SELECT * FROM v_spans WHERE start_ts >= {micros(2024, 1, 15)}")
def retained_spans(t: AnalogTables) -> DataFrame:
    return tracestore.retain(t.spans(), micros(2024, 1, 15))


@query(f"""
SELECT * FROM v_spans WHERE ('0x' || substr(md5(trace_id::VARCHAR), 1, 12))::BIGINT < {1 << 46}""")
def sampled_traces(t: AnalogTables) -> DataFrame:
    return tracestore.sample_traces(t.spans(), 0.25)


@query("SELECT * FROM v_spans WHERE NOT scanned")
def insert_ignore_spans(t: AnalogTables) -> DataFrame:
    """All spans arrive, sent twice; the scanned ones are stored already."""
    new = stage(t.spans(), "new-spans")
    return tracestore.insert_ignore(
        new.unionByName(new), t.spans(parents=False).where("scanned"), spans.SPAN_KEY
    )


# Annotation kinds


@query("SELECT trace_id_high, trace_id, span_id, a_key, a_value FROM v_annotations WHERE a_type <> -1")
def span_tags(t: AnalogTables) -> DataFrame:
    return tracestore.span_tags(t.annotations())


@query("""
SELECT trace_id_high, trace_id, span_id, 0 AS page, '{"k":"' || a_value || '"}' AS tags
FROM v_annotations WHERE a_type <> -1""")
def span_tag_maps(t: AnalogTables) -> DataFrame:
    return tracestore.span_tag_maps(t.annotations()).withColumn("tags", F.to_json("tags"))
