"""Stream form of the trace copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripspark.functions.times import time_of_micros
from tripspark.operators.skew import lookup_join
from tripspark.operators.spans import ROW_COLUMNS, readable_annotations, span_rows, to_points
from tripspark.session import stage
from tripspark.sinks.commits import CommitLog
from tripspark.sinks.points import to_line_protocol
from tripspark.sources.daystore import DayStore, known_parts, noted_parts
from tripspark.streaming.files import with_trigger
from tripspark.vocabulary import SPAN_MEASUREMENT


def join_streams(
    spans: DataFrame,
    annotations: DataFrame,
    delay: str = "10 seconds",
    bound: str = "20 seconds",
    use_high: bool = False,
    early: str = "1 second",
) -> DataFrame:
    """Spans left joined with annotations from `early` before the span's start, as clocks differ, until `bound` after it.

    Records may come up to `delay` late. A span without annotations comes out once no match can arrive any more. Spans
    without start, and annotations that meet no span in time, don't come out here: `settle_copy` sends them.
    """
    left = (
        spans.where(F.col("start_ts").isNotNull())
        .select("trace_id_high", "trace_id", "id", "parent_id", "name", "start_ts", "duration")
        .withColumn("span_time", time_of_micros(F.col("start_ts")))
        .withWatermark("span_time", delay)
        .alias("s")
    )
    right = (
        readable_annotations(annotations.where(F.col("a_timestamp").isNotNull()))
        .withColumn("note_time", time_of_micros(F.col("a_timestamp")))
        .withWatermark("note_time", delay)
        .alias("a")
    )
    same = (F.col("s.trace_id") == F.col("a.trace_id")) & (F.col("s.id") == F.col("a.span_id"))
    if use_high:
        same = same & (F.col("s.trace_id_high") == F.col("a.trace_id_high"))
    timely = F.expr(f"a.note_time BETWEEN s.span_time - INTERVAL {early} AND s.span_time + INTERVAL {bound}")
    joined = left.join(right, same & timely, "leftOuter")
    columns = {
        c: F.col(f"s.{c}") for c in ("trace_id", "parent_id", "name", "start_ts", "duration")
    } | {"span_id": F.coalesce("a.span_id", "s.id")}
    alone = F.col("a.span_id").isNull().alias("alone")
    return joined.select(*[columns.get(c, F.col(f"a.{c}")).alias(c) for c in ROW_COLUMNS], alone)


POINTS = (
    "time_us bigint, time timestamp_ntz, trace_id bigint, span_id bigint, parent_id bigint, name string, "
    "endpoint_service_name string, endpoint_port int, a_key string, a_value string, a_type int, endpoint_ipv4 int, "
    "endpoint_ipv6 string, start_ts bigint, duration bigint, a_number int, alone boolean"
)


def point_store(spark: SparkSession, out: str) -> DayStore:
    """Points by day and batch, found by trace; `alone` marks a span that was sent without annotation."""
    return DayStore(spark, f"{out}/points", StructType.fromDDL(POINTS), "time_us", ["trace_id"])


def _write_points(points: DataFrame, batch_id: int, out: str) -> None:
    point_store(points.sparkSession, out).write(points, batch_id)
    to_line_protocol(points.drop("alone"), SPAN_MEASUREMENT).write.mode("overwrite").text(f"{out}/lines/batch_id={batch_id}")


def write_copy_batch(rows: DataFrame, batch_id: int, out: str) -> None:
    """Points as a table and as text lines, in folders named after the batch: a batch run again replaces its own."""
    points = to_points(rows, more=("alone",)).persist()
    try:
        _write_points(points, batch_id, out)
    finally:
        points.unpersist()


def start_copy(
    spans: DataFrame,
    annotations: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    delay: str = "10 seconds",
    bound: str = "20 seconds",
    use_high: bool = False,
    early: str = "1 second",
) -> StreamingQuery:
    """Copy span rows to points. The checkpoint records what was read, so no rows are marked."""
    writer = join_streams(spans, annotations, delay, bound, use_high, early).writeStream.option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append").foreachBatch(lambda rows, batch_id: write_copy_batch(rows, batch_id, out))
    return with_trigger(writer, trigger).start()


def settle_copy(spans: DayStore, annotations: DayStore, out: str, use_high: bool = False) -> int:
    """Send what the stream left out: spans without start, annotations that came early or late. Gives the days it had to settle.

    Looks only at days and batches of the two stores that came since the last call, and at the traces in them: their spans,
    annotations and sent points are looked up by trace. Points that the batch copy would send and the stream has not are
    written as one more batch; a span that was sent alone and has annotations now is taken back. With both, `read_points`
    gives the points of the batch copy. Call it for days whose stream is through; a call that stopped is done again.
    """
    spark, log = spans.spark, CommitLog(spans.spark, f"{out}/settled")
    now = {"spans": spans.parts(), "annotations": annotations.parts()}
    new = {name: sorted(set(parts) - known_parts(log, name)) for name, parts in now.items()}
    if not any(new.values()):
        return 0
    run = log.state().number + 1
    keys = spans.of_parts(new["spans"]).select(*spans.keys).union(annotations.of_parts(new["annotations"]).select(*spans.keys))
    touched = stage(keys.distinct(), "touched-traces")
    noted = annotations.of_traces(touched, now["annotations"])
    rows = span_rows(spans.of_traces(touched, now["spans"]), noted, parity=True, use_high=use_high, own_id="own")
    rows = rows.withColumn("alone", F.col("span_id").isNull()).withColumn("span_id", F.coalesce("span_id", "own"))
    wanted = stage(to_points(rows, more=("alone",)), "wanted-points")
    store = point_store(spark, out)
    others = [p for p in store.parts() if p.batch_id != -run]  # but what a stopped call has left
    sent = stage(store.of_traces(touched.select("trace_id"), others), "sent-points")
    _write_points(stage(wanted.exceptAll(sent), "settled-points"), -run, out)
    lonely = ["trace_id", "span_id"]
    gone = sent.where("alone").select(*lonely).join(wanted.where("alone").select(*lonely), lonely, "left_anti")
    log.commit("settle", run, [log.write(gone, "gone", run)], notes={name: noted_parts(parts) for name, parts in now.items()})
    return len({p.day for parts in new.values() for p in parts})


def read_points(spark: SparkSession, out: str) -> DataFrame:
    """Points of all batches, without spans that were sent alone and have been taken back."""
    log = CommitLog(spark, f"{out}/settled")
    points = point_store(spark, out).stored().where(F.col("batch_id") >= -log.state().number)
    gone = log.read("gone", "trace_id bigint, span_id bigint")
    kept = lookup_join(points.where("alone"), gone, ["trace_id", "span_id"], "left_anti")
    return points.where("NOT alone").unionByName(kept).drop("alone", "day", "batch_id")
