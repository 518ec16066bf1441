"""Queries over tables that are stored by day, in batches and with ledgers: each writes its store first and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.operators import integrity, quantiles, spans, tracestore
from tripspark.operators.skew import lookup_join
from tripspark.plans import trace_copy, trace_search
from tripspark.queries.jobs import lines_of
from tripspark.queries.registry import query
from tripspark.queries.traces import micros
from tripspark.session import fresh_path, stage
from tripspark.sinks.commits import CommitLog
from tripspark.sinks.lastwrite import LastWriteTable
from tripspark.sources.analog import AnalogTables
from tripspark.sources.daystore import DayStore


def span_store(t: AnalogTables, rows: DataFrame, keys: list[str] | None = None) -> DayStore:
    return DayStore(t.spark, fresh_path(t.spark, "span-store"), rows.schema, "start_ts", keys)


def note_store(t: AnalogTables, rows: DataFrame, keys: list[str] | None = None) -> DayStore:
    return DayStore(t.spark, fresh_path(t.spark, "annotation-store"), rows.schema, "a_timestamp", keys)


def both_stores(t: AnalogTables) -> tuple[DayStore, DayStore]:
    started, noted = t.spans(), t.annotations()
    stores = span_store(t, started), note_store(t, noted)
    stores[0].write(started, 0)
    stores[1].write(noted, 0)
    return stores


# Trace search


@query("""
SELECT s.*, 0 AS page,
       CASE WHEN a.span_id IS NULL THEN '[]' ELSE CAST(to_json([{'a_timestamp': a.a_timestamp, 'a_key': a.a_key,
         'a_value': a.a_value, 'a_type': a.a_type, 'endpoint_service_name': a.endpoint_service_name}]) AS VARCHAR) END
         AS annotations
FROM v_spans s LEFT JOIN v_annotations a ON s.trace_id = a.trace_id AND s.id = a.span_id
WHERE s.trace_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def traces_by_ids_stored(t: AnalogTables) -> DataFrame:
    """Spans, with nested annotations, of the traces numbered like customers in debt."""
    ids = t.table("customer").where(F.col("c_acctbal") < 0).select(
        F.lit(0).cast("bigint").alias("trace_id_high"), F.col("c_custkey").alias("trace_id")
    )
    found = trace_search.traces_by_ids_stored(*both_stores(t), ids)
    return found.withColumn("annotations", F.to_json("annotations", {"ignoreNullFields": "false"}))


@query(f"""
SELECT * FROM v_spans WHERE trace_id IN (
  SELECT s.trace_id FROM v_spans s
  JOIN v_annotations a ON s.trace_id = a.trace_id AND s.id = a.span_id
  JOIN v_services v ON s.trace_id = v.trace_id AND s.id = v.id
  WHERE s.name = 'error' AND v.service = 'svc-3-mobility-service' AND a.a_key = 'k' AND a.a_type = 6
    AND s.start_ts BETWEEN {micros(2024, 1, 8)} AND {micros(2024, 1, 22)} AND s.duration BETWEEN 20000 AND 200000)""")
def find_traces_stored(t: AnalogTables) -> DataFrame:
    return trace_search.find_traces_stored(
        *both_stores(t), name="error", service="svc-3-mobility-service", key="k", a_type=6,
        start=micros(2024, 1, 8), end=micros(2024, 1, 22), min_duration=20_000, max_duration=200_000,
    )


@query(f"SELECT * FROM v_spans WHERE start_ts BETWEEN {micros(2024, 1, 8)} AND {micros(2024, 1, 9)}")
def spans_of_days(t: AnalogTables) -> DataFrame:
    rows = t.spans()
    store = span_store(t, rows)
    store.write(rows, 0)
    return store.between(micros(2024, 1, 8), micros(2024, 1, 9))


@query("SELECT * FROM v_spans WHERE NOT scanned")
def insert_ignore_stored(t: AnalogTables) -> DataFrame:
    """All spans arrive, sent twice; the scanned ones are in the store, in two batches."""
    new = stage(t.spans(), "new-spans")
    store = span_store(t, new, spans.SPAN_KEY)
    for batch in (0, 1):
        store.write(new.where(f"scanned AND id % 2 = {batch}"), batch)
    return trace_search.insert_ignore_stored(new.unionByName(new), store)


# Copy jobs


@query(lines_of("v_varied_points"))
def span_copy_runs(t: AnalogTables) -> DataFrame:
    """Spans come in five parts and are copied in five runs; the ledger is merged twice on the way.

    The fourth run stops between its writes and is done again, the last one is called twice.
    """
    log, rows, notes = CommitLog(t.spark, fresh_path(t.spark, "span-copy")), t.varied_spans(), t.varied_annotations()
    ledger = trace_copy.span_keys(log, rows, buckets=8, merge_at=2)
    for run in (0, 1, 2, 3, 4, 4):
        if run == 3:
            log.write(t.spark.createDataFrame([("left by a stopped run",)], "value string"), "lines", run, form="text")
        trace_copy.run_span_copy(rows.where(f"id % 5 <= {run}"), notes, log, run, use_high=True, ledger=ledger)
    return log.read_text("lines")


@query("""
SELECT 'zipkin_annotations trace_id=' || trace_id || 'i,span_id=' || span_id || 'i,a_key="' || a_key || '",a_value="' || a_value
  || '",a_type=' || a_type || 'i,endpoint_ipv4=' || endpoint_ipv4 || 'i,endpoint_ipv6="",endpoint_port=' || endpoint_port
  || 'i,endpoint_service_name="' || endpoint_service_name || '" ' || a_timestamp * 1000 AS value
FROM v_varied_annotations WHERE NOT scanned AND a_timestamp IS NOT NULL""")
def annotation_copy_runs(t: AnalogTables) -> DataFrame:
    """Annotations come in three parts; missing times are part of the key."""
    log, notes = CommitLog(t.spark, fresh_path(t.spark, "annotation-copy")), t.varied_annotations()
    ledger = trace_copy.annotation_keys(log, notes, buckets=8, merge_at=2)
    for run in (0, 1, 2, 2):
        trace_copy.run_annotation_copy(notes.where(f"span_id % 3 <= {run}"), log, run, ledger)
    return log.read_text("annotation_lines")


@query(lines_of("""(
SELECT time_us, trace_id, span_id, parent_id, name, endpoint_service_name, endpoint_port, a_key, a_value, a_type, endpoint_ipv4,
       endpoint_ipv6, start_ts, duration, a_number FROM v_varied_points
UNION ALL
SELECT start_ts, trace_id, id, 0, name, '', 0, '', '', 0, 0, '', start_ts, duration, 1 FROM v_varied_spans
WHERE id % 4 = 3 AND NOT scanned AND start_ts IS NOT NULL)"""))
def span_copy_late(t: AnalogTables) -> DataFrame:
    """Annotations of odd spans, and all events, come after the first run, which sends some spans alone.

    The second run sends new spans with all they have, and late annotations with their spans. It is stopped once, and
    called again after it ended.
    """
    rows, notes = t.varied_spans(), t.varied_annotations()
    store, noted = span_store(t, rows), note_store(t, notes)
    log = CommitLog(t.spark, fresh_path(t.spark, "late-copy"))
    late = (F.col("span_id") % 2 == 1) | (F.col("a_type") == -1)
    store.write(rows.where("id % 4 <> 1"), 0)
    noted.write(notes.where(~late), 0)
    trace_copy.run_stored_copy(store, noted, log, 0)
    store.write(rows.where("id % 4 = 1"), 1)
    noted.write(notes.where(late), 1)
    log.write(t.spark.createDataFrame([("left by a stopped run",)], "value string"), "lines", 1, form="text")
    for _ in range(2):
        trace_copy.run_stored_copy(store, noted, log, 1)
    return log.read_text("lines")


# Stored points


@query("""
SELECT * EXCLUDE (place, run) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY time_us ORDER BY run DESC, trace_id DESC, span_id DESC, a_key DESC, a_value DESC) AS place
  FROM (SELECT p.*, r.run FROM v_varied_points p JOIN range(4) r(run)
        ON p.trace_id % 4 = r.run OR p.trace_id % 4 = (r.run + 1) % 4)) WHERE place = 1""")
def last_write_table(t: AnalogTables) -> DataFrame:
    """Points come in four runs, each point in two of them; days are compacted after the third, one run is called twice."""
    points = spans.to_points(spans.span_rows(t.varied_spans(), t.varied_annotations(), use_high=True))
    points = stage(points, "points")
    table = LastWriteTable(CommitLog(t.spark, fresh_path(t.spark, "last-write")), "points", points.schema)
    for run in (0, 1, 1, 2):
        table.write(points.where(F.pmod(F.col("trace_id"), F.lit(4)).isin(run, (run + 1) % 4)), run)
    table.compact(at=3)
    table.write(points.where(F.pmod(F.col("trace_id"), F.lit(4)).isin(3, 0)), 3)
    return table.read()


SHARES = (0.5, 0.9, 0.99)


@query("""
SELECT CAST(date_trunc('day', time) AS TIMESTAMP) AS window_start, endpoint_service_name AS service, COUNT(duration) AS points,
       TRUE AS p50_near, TRUE AS p90_near, TRUE AS p99_near
FROM v_varied_points GROUP BY ALL""")
def duration_quantiles_rollup(t: AnalogTables) -> DataFrame:
    """Quantiles per day and service from stored sketches per minute, merged to hours and then to days.

    The flags tell that the rank of an answer among the durations is within twice the error that the sketch states.
    """
    points = stage(spans.to_points(spans.span_rows(t.varied_spans(), t.varied_annotations(), use_high=True)), "points")
    minutes = stage(quantiles.duration_sketches(points), "minute-sketches")
    hours = stage(quantiles.rolled_up(minutes, "1 hour"), "hour-sketches")
    days = stage(quantiles.with_quantiles(quantiles.rolled_up(hours, "1 day"), SHARES), "day-quantiles")
    raw = points.select(
        F.date_trunc("day", "time").cast("timestamp_ntz").alias("window_start"), F.col("endpoint_service_name").alias("service"), "duration"
    )
    met = lookup_join(raw, days.drop("sketch"), ["window_start", "service"], "inner", check_size=True)
    near = []
    for share in SHARES:
        name = f"p{round(share * 100)}"
        answer = F.col(f"duration_{name}")
        below, upto = F.count_if(F.col("duration") < answer), F.count_if(F.col("duration") <= answer)
        slack = 2 * quantiles.RANK_ERROR * F.col("points")
        near.append(((below <= share * F.col("points") + slack) & (upto >= share * F.col("points") - slack)).alias(f"{name}_near"))
    return met.groupBy("window_start", "service", "points", *[f"duration_p{round(q * 100)}" for q in SHARES]).agg(*near).select(
        "window_start", "service", "points", *[f"p{round(q * 100)}_near" for q in SHARES]
    )


# Defaults


@query("""
SELECT trace_id, id, COALESCE(parent_id, 0) AS parent_id, COALESCE(start_ts, 0) AS start_ts, COALESCE(duration, 0) AS duration
FROM v_varied_spans""")
def spans_with_defaults(t: AnalogTables) -> DataFrame:
    filled = integrity.with_defaults(t.varied_spans(), {"parent_id": 0, "start_ts": 0, "duration": 0})
    return filled.select("trace_id", "id", "parent_id", "start_ts", "duration")


@query("SELECT DISTINCT lower(name) AS name FROM v_spans")
def span_names_without_case(t: AnalogTables) -> DataFrame:
    """Names as they come, some of them in capitals."""
    rows = t.spans(parents=False)
    mixed = rows.withColumn("name", F.when(F.col("id") % 2 == 0, F.upper("name")).otherwise(F.col("name")))
    return tracestore.span_names(mixed, ignore_case=True)
