"""Streams of spans, points and service links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripspark.functions.times import day_of_micros, time_of_micros
from tripspark.operators.skew import lookup_join
from tripspark.operators.tracestore import point_counts, span_links
from tripspark.session import stage
from tripspark.sinks.commits import CommitLog
from tripspark.sinks.tables import has_batches, replace_batch
from tripspark.sources.daystore import DayStore, Part, known_parts, noted_parts
from tripspark.streaming.files import with_trigger


def first_of_key(stream: DataFrame, keys: list[str], micros: str, delay: str = "10 minutes") -> DataFrame:
    """Drops records whose key was seen within `delay`; records with a NULL in the key all stay."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    once = (
        stream.where(whole)
        .withColumn("_time", time_of_micros(F.col(micros)))
        .withWatermark("_time", delay)
        .dropDuplicatesWithinWatermark(keys)
        .drop("_time")
    )
    return once.unionByName(stream.where(~whole))


def stream_point_counts(
    points: DataFrame, delay: str = "10 minutes", width: str = "1 minute", slide: str | None = None
) -> DataFrame:
    """Counts per time window and service; a window comes out once no point of it can arrive any more."""
    timed = points.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", delay)
    return point_counts(timed, width, slide)


def stream_links(
    spans: DataFrame, delay: str = "10 minutes", bound: str = "1 hour", width: str = "1 minute"
) -> DataFrame:
    """Calls per day, parent service and child service from a stream of spans with `service`: day, parent, child, calls.

    Children are counted per parent span, service and window of `width` first and meet the parent then, so what waits for a
    parent is bounded by its services and windows, however many children it has. A child may start up to `bound` after its
    parent, give or take a window. `settle_links` counts the others.
    """
    # Every span moves the watermark, also one that has no service or parent.
    timed = spans.withColumn("_time", time_of_micros(F.col("start_ts"))).withWatermark("_time", delay)
    timed = timed.where(F.col("service").isNotNull())
    child = (
        timed.where(F.col("parent_id").isNotNull())
        .select("trace_id_high", "trace_id", "parent_id", "start_ts", F.col("service").alias("child"), "_time")
        .groupBy(
            F.window("_time", width).alias("_window"), "trace_id_high", "trace_id", "parent_id",
            day_of_micros(F.col("start_ts")).alias("day"), "child",
        )
        .agg(F.count(F.lit(1)).alias("calls"))
        .withColumn("_at", F.window_time("_window"))
        .drop("_window")
        .alias("c")
    )
    parent = timed.select("trace_id_high", "trace_id", "id", F.col("service").alias("parent"), "_time").alias("p")
    same = (
        (F.col("c.trace_id_high") == F.col("p.trace_id_high"))
        & (F.col("c.trace_id") == F.col("p.trace_id"))
        & (F.col("c.parent_id") == F.col("p.id"))
    )
    timely = F.expr(f"c._at BETWEEN p._time AND p._time + INTERVAL {bound} + INTERVAL {width}")
    return child.join(parent, same & timely).where(F.col("parent") != F.col("child")).select("day", "parent", "child", "calls")


def start_links(
    spans: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    delay: str = "10 minutes",
    bound: str = "1 hour",
    width: str = "1 minute",
) -> StreamingQuery:
    """Write the counts of each batch; `read_links` adds them up."""

    def write(links: DataFrame, batch_id: int) -> None:
        replace_batch(links.groupBy(*LINK).agg(F.sum("calls").alias("calls")), f"{out}/streamed", batch_id)

    writer = stream_links(spans, delay, bound, width).writeStream.option("checkpointLocation", checkpoint)
    return with_trigger(writer.outputMode("append").foreachBatch(write), trigger).start()


LINK = ["day", "parent", "child"]
LINKS = "day date, parent string, child string, calls long"


def settle_links(spans: DayStore, annotations: DayStore, out: str) -> int:
    """Count the links of stored spans exactly, whatever their times. Gives the days and batches that were new.

    Looks at the traces of days and batches that came since the last call: what their links were before is taken off, what
    they are now is added, so a late parent, child or service is counted too.
    """
    spark, log = spans.spark, CommitLog(spans.spark, f"{out}/settled")
    now = {"spans": spans.parts(), "annotations": annotations.parts()}
    old = {name: sorted(known_parts(log, name)) for name in now}
    new = {name: sorted(set(now[name]) - set(old[name])) for name in now}
    if not any(new.values()):
        return 0
    run = log.state().number + 1
    keys = spans.of_parts(new["spans"]).select(*spans.keys).union(annotations.of_parts(new["annotations"]).select(*spans.keys))
    touched = stage(keys.distinct(), "touched-traces")

    def counted(parts: dict[str, list[Part]], sign: int) -> DataFrame:
        links = span_links(spans.of_traces(touched, parts["spans"]), annotations.of_traces(touched, parts["annotations"]))
        return links.select(*LINK, (sign * F.col("calls")).alias("calls"))

    change = counted(now, 1)
    if old["spans"]:
        change = change.unionByName(counted(old, -1))
    change = change.groupBy(*LINK).agg(F.sum("calls").alias("calls")).where("calls <> 0")
    log.commit("settle", run, [log.write(change, "links", run)], notes={name: noted_parts(parts) for name, parts in now.items()})
    return sum(map(len, new.values()))


def read_links(spark: SparkSession, out: str) -> DataFrame:
    """Links per day: as settled, for days that have been, else as streamed."""
    streamed = spark.createDataFrame([], LINKS)
    if has_batches(spark, f"{out}/streamed"):
        streamed = spark.read.schema(LINKS).parquet(f"{out}/streamed")
    settled = CommitLog(spark, f"{out}/settled").read("links", LINKS)
    waiting = lookup_join(streamed, settled.select("day").distinct(), ["day"], "left_anti", check_size=True)
    counts = settled.unionByName(waiting.select(*LINK, "calls")).groupBy(*LINK).agg(F.sum("calls").alias("call_count"))
    return counts.where("call_count > 0")
