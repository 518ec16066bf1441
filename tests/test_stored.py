"""Tables stored by day, commits, ledgers, stored points, sketches and routes by pair."""

from __future__ import annotations

import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.conftest import rows
from tests.test_spans import note, span
from tripspark.operators import integrity, quantiles, skew
from tripspark.operators.integrity import TableRules
from tripspark.operators.spans import SPAN_KEY
from tripspark.operators.tracestore import find_traces, insert_ignore
from tripspark.plans import trace_copy
from tripspark.plans.trace_search import find_traces_stored, insert_ignore_stored, traces_by_ids_stored
from tripspark.plans.trips import trip_search
from tripspark.schemas import struct_of
from tripspark.sinks.commits import CommitLog
from tripspark.sinks.lastwrite import LastWriteTable
from tripspark.sinks.ledger import Ledger
from tripspark.sources import daystore
from tripspark.sources.daystore import DayStore, Part
from tripspark.sources.pairroutes import PairRoutes

SEC = 1_000_000
DAY = 86_400 * SEC
T0 = 1_704_067_200 * SEC  # 2024-01-01


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def days_read(df):
    """Days in the partition filters of all scans."""
    filters = re.findall(r"PartitionFilters: \[(.*?), PushedFilters", df._jdf.queryExecution().toString(), re.S)
    return set(re.findall(r"\d{4}-\d\d-\d\d", " ".join(filters))) | {str(date.fromordinal(719163 + int(n))) for n in re.findall(r"\b1\d{4}\b", " ".join(filters))}


def put(spark, tmp_path, batches, name="spans", time="start_ts", keys=None):
    store = DayStore(spark, str(tmp_path / name), struct_of(name), time, keys)
    for batch, records in enumerate(batches):
        store.write(spark.createDataFrame(records, struct_of(name)), batch)
    return store


def spans_of(traces, day, step=0):
    return [(0, t, t * 100 + day * 10 + step, "n", None, None, T0 + day * DAY + t * SEC, 5, False) for t in traces]


# Day store


@pytest.fixture
def store(spark, tmp_path):
    """Trace 1 on days 0 and 5, trace 2 on day 1, others on days 2 to 4, one span without time."""
    batches = [spans_of([1], 0) + spans_of([2], 1), spans_of(range(10, 40), 2) + spans_of([1], 5), spans_of(range(50, 90), 3) + spans_of([7], 4)]
    lost = (0, 3, 333, "n", None, None, None, 5, False)
    return put(spark, tmp_path, [*batches, [lost]])


def test_lookup_reads_only_days_that_hold_the_trace(spark, store):
    ids = spark.createDataFrame([(0, 1)], "trace_id_high long, trace_id long")
    found = store.of_traces(ids)
    assert rows(found, "id") == [(100,), (150,)]
    assert store.parts_in(store.hits(ids, True)) == [Part(date(2024, 1, 1), 0), Part(date(2024, 1, 6), 1)]
    assert days_read(found) == {"2024-01-01", "2024-01-06"}
    assert rows(store.of_traces(ids, [Part(date(2024, 1, 6), 1)]), "id") == [(150,)]
    assert store.of_traces(ids.limit(0)).count() == 0
    lost = spark.createDataFrame([(0, 3), (None, None)], "trace_id_high long, trace_id long")
    assert rows(store.of_traces(lost), "id") == [(333,)]


def test_very_many_ids_are_joined(spark, store, monkeypatch):
    ids = spark.createDataFrame([(0, t) for t in range(100)], "trace_id_high long, trace_id long")
    by_index = rows(store.of_traces(ids), "id")
    monkeypatch.setattr(daystore, "MAX_IDS", 3)
    assert rows(store.of_traces(ids), "id") == by_index == rows(store.rows(), "id")


def test_index_tells_days_apart(spark, tmp_path, monkeypatch):
    """Small blocks, so that a day has several; nothing is missed, and few days answer falsely."""
    monkeypatch.setattr(daystore, "BITS_PER_TRACE", 2_000)
    store = put(spark, tmp_path, [[s for d in range(6) for s in spans_of(range(d * 1000, d * 1000 + 60), d)]])
    assert {r["level"] for r in store.index().select("level").distinct().collect()} == {2}
    for trace, there in ((2_005, {2}), (5_059, {5}), (70, set())):
        ids = spark.createDataFrame([(0, trace)], "trace_id_high long, trace_id long")
        days = {p.day.day - 1 for p in store.parts_in(store.hits(ids, True))}
        assert days >= there and len(days) <= len(there) + 1
        assert store.parts_in(store.hits(ids, False)) == store.parts_in(store.hits(ids, True))


def test_time_range_reads_its_days(store):
    found = store.between(T0 + DAY, T0 + 2 * DAY + 12 * SEC)
    assert days_read(found) == {"2024-01-02", "2024-01-03"}
    assert rows(found, "trace_id") == [(2,), (10,), (11,), (12,)]
    assert store.between(None, T0 + 5 * SEC).count() == 1


def test_batch_again_replaces_its_index_and_rows(spark, tmp_path):
    store = put(spark, tmp_path, [spans_of([1, 2], 0), spans_of([3], 0)])
    store.write(spark.createDataFrame(spans_of([4], 0), struct_of("spans")), 1)
    assert rows(store.rows(), "trace_id") == [(1,), (2,), (4,)]
    ids = spark.createDataFrame([(0, 4)], "trace_id_high long, trace_id long")
    assert store.of_traces(ids).count() == 1 and store.parts() == [Part(date(2024, 1, 1), 0), Part(date(2024, 1, 1), 1)]


def test_empty_store(spark, tmp_path):
    store = put(spark, tmp_path, [])
    ids = spark.createDataFrame([(0, 4)], "trace_id_high long, trace_id long")
    assert store.rows().count() == 0 and store.of_traces(ids).count() == 0 and store.parts() == []
    assert insert_ignore_stored(spark.createDataFrame(spans_of([1], 0), struct_of("spans")), store).count() == 1


def test_search_like_the_plain_form(spark, tmp_path):
    spans = [span(i, trace=i % 7, start=T0 + (i % 5) * DAY + i, name="ab"[i % 2], duration=i) for i in range(60)]
    notes = [note(i, "k", trace=i % 7, time=T0 + i % 3 * DAY, service=f"s{i % 4}") for i in range(0, 60, 2)]
    stores = put(spark, tmp_path, [spans[:30], spans[30:]]), put(spark, tmp_path, [notes], "annotations", "a_timestamp")
    plain = spark.createDataFrame(spans, struct_of("spans")), spark.createDataFrame(notes, struct_of("annotations"))
    for conditions in (
        {"name": "a", "start": T0 + DAY, "end": T0 + 2 * DAY},
        {"service": "s2", "start": T0, "end": T0 + DAY},
        {"key": "k", "a_type": 6, "min_duration": 5, "max_duration": 9},
        {"name": "none"},
        {},
    ):
        assert rows(find_traces_stored(*stores, **conditions)) == rows(find_traces(*plain, **conditions)), conditions
    ids = spark.createDataFrame([(0, 3)], "trace_id_high long, trace_id long")
    found = traces_by_ids_stored(*stores, ids)
    assert {r["trace_id"] for r in found.collect()} == {3} and found.where("size(annotations) = 1").count() == len([i for i in range(0, 60, 2) if i % 7 == 3])


def test_insert_ignore_reads_possible_days_only(spark, tmp_path):
    store = put(spark, tmp_path, [spans_of([1, 2], 0), spans_of([3], 4)], keys=SPAN_KEY)
    new = spark.createDataFrame(spans_of([1], 0) + spans_of([8], 0) * 2, struct_of("spans"))
    found = insert_ignore_stored(new, store)
    assert rows(found) == rows(insert_ignore(new, store.rows(), SPAN_KEY))
    assert days_read(found) == {"2024-01-01"}


# Commits and ledgers


def test_only_committed_folders_count(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    one = spark.createDataFrame([(1,)], "x int")
    assert log.read("t", "x int").count() == 0 and not log.done("job", 0)
    left = log.write(one, "t", 0)
    assert log.read("t", "x int").count() == 0
    kept = log.write(one, "t", 0)
    log.commit("job", 0, [kept], notes={"seen": [1]})
    assert log.done("job", 0) and not log.done("job", 1) and log.read("t", "x int").count() == 1
    log.commit("job", 1, [log.write(one, "t", 1)], [kept])
    assert log.folders("t")[0].run == 1 and log.state().notes == {"seen": [1]} and log.state().number == 2
    assert log.clear("t") == 2 and log.read("t", "x int").count() == 1
    assert left not in log.folders("t") and not (tmp_path / "log" / left.path).exists()


def test_a_number_is_committed_once(spark, tmp_path, monkeypatch):
    log = CommitLog(spark, str(tmp_path / "log"))
    before = log.state()
    log.commit("job", 0, [])
    monkeypatch.setattr(CommitLog, "state", lambda self: before)  # as another writer that began earlier sees it
    with pytest.raises(RuntimeError):
        log.commit("job", 0, [])


KEY = StructType().add("trace_id", "long").add("value", "string")


def test_ledger_merges_and_reads_touched_buckets(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    ledger = Ledger(log, "keys", KEY, ["trace_id"], buckets=8, merge_at=3)
    data = spark.createDataFrame([(i, None if i % 5 == 0 else "v") for i in range(60)], KEY)
    seen = set()
    for run in range(5):
        part = data.where(f"trace_id <= {run * 12 + 11}")
        new = ledger.unprocessed(part)
        fresh = {r["trace_id"] for r in new.collect()}
        assert fresh == set(range(run * 12, run * 12 + 12)) and not fresh & seen
        seen |= fresh
        log.commit("job", run, [ledger.addition(new, run)])
        ledger.merge("merge")
        assert len([f for f in log.folders("keys") if not f.base]) < 3
    assert sum(f.base for f in log.folders("keys")) == 1 and ledger.keys().count() == 60
    one = ledger.unprocessed(data.where("trace_id IN (7, 10)"))
    assert one.count() == 0
    assert "PartitionFilters: [bucket" in plan_of(one)


# Copy runs


def lines(log):
    return sorted(r["value"] for r in log.read_text("lines").collect())


def test_stopped_copy_gives_each_line_once(spark, tmp_path, monkeypatch):
    spans = spark.createDataFrame(spans_of([1, 2], 0), struct_of("spans"))
    notes = spark.createDataFrame([note(100, trace=1, time=T0)], struct_of("annotations"))
    log = CommitLog(spark, str(tmp_path / "log"))

    def stop(self, *args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", stop)
        with pytest.raises(KeyboardInterrupt):
            trace_copy.run_span_copy(spans, notes, log, 0)
    assert lines(log) == []
    for run in (0, 0, 1):
        trace_copy.run_span_copy(spans, notes, log, run)
        assert len(lines(log)) == 2
    assert len(list((tmp_path / "log" / "lines").iterdir())) == 3  # the stopped run's stay until they are cleared
    assert log.clear("lines") == 1 and len(lines(log)) == 2


def test_late_annotation_is_sent_by_the_next_run(spark, tmp_path):
    store = put(spark, tmp_path, [spans_of([1, 2], 0)])
    noted = put(spark, tmp_path, [[note(100, "in time", trace=1, time=T0)]], "annotations", "a_timestamp")
    log = CommitLog(spark, str(tmp_path / "log"))
    trace_copy.run_stored_copy(store, noted, log, 0)
    assert len(lines(log)) == 2 and sum('a_key=""' in x for x in lines(log)) == 1
    noted.write(spark.createDataFrame([note(200, "late", trace=2, time=T0 + DAY), note(999, "no span", trace=9, time=T0)], struct_of("annotations")), 1)
    store.write(spark.createDataFrame(spans_of([3], 1), struct_of("spans")), 1)
    for _ in range(2):
        trace_copy.run_stored_copy(store, noted, log, 1)
    found = lines(log)
    assert len(found) == 4 and sum('a_key="late"' in x for x in found) == 1 and sum('a_key="in time"' in x for x in found) == 1
    trace_copy.run_stored_copy(store, noted, log, 2)  # nothing new
    assert lines(log) == found


# Stored points

POINT = "time_us long, trace_id long, span_id long, a_key string, a_value string, x int"


def test_last_write_counts_and_compaction_keeps_it(spark, tmp_path):
    schema = spark.createDataFrame([], POINT).schema
    log = CommitLog(spark, str(tmp_path / "log"))
    table = LastWriteTable(log, "points", schema)
    rng, state = random.Random(4), {}
    for run in range(6):
        batch = [(T0 + rng.randrange(40) * DAY // 10, rng.randrange(9), rng.randrange(9), "k", None, rng.randrange(99)) for _ in range(30)]
        table.write(spark.createDataFrame(batch, schema), run)
        table.write(spark.createDataFrame(batch[:1], schema), run)  # the run again: nothing changes
        last = {}
        for p in batch:
            last[p[0]] = max(last.get(p[0], (-1,)), p[1:4] + ("", p[5]))
        state |= last
        if run in (2, 4):
            assert table.compact(at=3 if run == 2 else 2)
        assert {r["time_us"]: (r["trace_id"], r["span_id"], "k", "", r["x"]) for r in table.read().collect()} == state
    one = table.read(date(2024, 1, 2), date(2024, 1, 2))
    assert {r["time_us"] // DAY * DAY for r in one.collect()} == {T0 + DAY}
    assert all("day=2024-01-02" in f for f in one.inputFiles())  # folders of that day alone
    assert table.compact(at=50) == []


def test_merged_sketches_keep_the_rank_error(spark):
    points = spark.range(40_000).select(
        F.timestamp_micros(F.lit(T0) + F.col("id") * 3 * SEC).cast("timestamp_ntz").alias("time"),
        F.lit("s").alias("endpoint_service_name"),
        F.when(F.col("id") % 97 != 0, F.pmod(F.xxhash64("id"), F.lit(1_000_003))).alias("duration"),
    )
    minutes = quantiles.duration_sketches(points)
    assert minutes.count() == 2000
    days = quantiles.with_quantiles(quantiles.rolled_up(quantiles.rolled_up(minutes, "1 hour"), "1 day")).collect()
    values = points.where("duration IS NOT NULL").select(F.to_date("time").alias("day"), "duration").collect()
    for r in days:
        own = sorted(v["duration"] for v in values if v["day"] == r["window_start"].date())
        assert r["points"] == len(own)
        for share in (0.5, 0.9, 0.99):
            rank = sum(v <= r[f"duration_p{round(share * 100)}"] for v in own) / len(own)
            assert abs(rank - share) < 2 * quantiles.RANK_ERROR


# Routes by pair


def test_trip_search_without_shuffling_routes(spark, cities, routes, tmp_path):
    requests = spark.createDataFrame([(1, 1, 2), (2, 2, 3), (3, 1, 1), (4, 1, 99), (5, 3, 1)], struct_of("trip_requests"))
    store = PairRoutes(spark, "routes_plain", str(tmp_path / "routes"))
    store.write(routes, buckets=4)
    assert rows(store.rows(), "route_id", "service_provider") == rows(routes, "route_id", "service_provider")
    assert rows(trip_search(requests, cities, store)) == rows(trip_search(requests, cities, routes))
    pairs = requests.select("origin", "destination").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(store.of_pairs(pairs))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    side = plan[plan.index("SortMergeJoin") :].split(":- ", 1)[1].split("\n   +- ")[0].split("\n+- ")[0]
    assert "Bucketed: true" in side and "Exchange" not in side


def test_heavy_pair_is_cut(spark, cities, routes, tmp_path, force_hot):
    many = routes
    for _ in range(3):
        many = many.unionByName(many.where("origin = 1 AND destination = 2").withColumn("route_id", F.col("route_id") + 50))
    store = PairRoutes(spark, "routes_heavy", str(tmp_path / "routes"))
    store.write(many.distinct(), buckets=4)
    assert spark.table("routes_heavy").where("piece > 0").count() > 0
    pairs = spark.createDataFrame([(1, 2, "a"), (2, 1, "b"), (9, 9, "c")], "origin int, destination int, tag string")
    plain = many.distinct().join(pairs, ["origin", "destination"])
    assert rows(store.of_pairs(pairs), "route_id", "service_provider", "tag") == rows(plain, "route_id", "service_provider", "tag")


# Checks in one pass


def test_violations(spark):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (9, None), (9, "x,y")], "k int, t string")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    found = integrity.violations(
        [
            TableRules(child, keys={"child key": ["k", "t"]}, children={"child -> parent": ["k"]}, broken={"t missing": F.col("t").isNull()}),
            TableRules(parent, keys={"parent key": ["p"]}, parents={"child -> parent": ["p"]}, broken={"never": F.col("p") > 5}),
            TableRules(parent.limit(0), keys={"empty key": ["p"]}),
        ]
    )
    told = {r["rule"]: r["violations"] for r in found.collect()}
    assert told == {"child key": 1, "child -> parent": 2, "t missing": 1, "parent key": 1, "never": 0, "empty key": 0}
    assert plan_of(found).split("Initial Plan")[0].count("hashpartitioning(rule") == 2  # by rule and key, then the sums by rule


def test_key_parts_stay_apart(spark):
    rows_ = spark.createDataFrame([("a", "b,c"), ("a,b", "c"), ("1:a", "b"), ("1", ":ab")], "x string, y string")
    (told,) = integrity.violations([TableRules(rows_, keys={"k": ["x", "y"]})]).collect()
    assert told["violations"] == 0


def test_heavy_keys_with_very_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    monkeypatch.setattr(skew, "_partitions", lambda df: 100_000)  # the sizes of the lists follow; the test has 4
    df = spark.range(2_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert list(skew.hot_keys(df, ["k"])) == [df.where("k = 7").select(skew.key_hash(df, ["k"])).first()[0]]
