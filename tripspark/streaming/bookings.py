"""Stream form of booking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripspark.operators.booking import book, booked_rows, with_number
from tripspark.operators.skew import lookup_join
from tripspark.sinks.commits import CommitLog
from tripspark.sinks.tables import replace_batch
from tripspark.streaming.files import with_trigger


def first_requests(requests: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Streamed requests (request_id, service, route_id, requested_at); an id sent again within `delay` is dropped.

    Requests without id or time cannot be told apart and all stay, as in the batch form.
    """
    whole = F.col("request_id").isNotNull() & F.col("requested_at").isNotNull()
    once = (
        requests.where(whole).withWatermark("requested_at", delay).dropDuplicatesWithinWatermark(["request_id"])
    )
    return once.unionByName(requests.where(~whole))


def _asked_routes(asked: DataFrame, routes: DataFrame) -> DataFrame:
    """Routes that a request of the batch names: the batch is small, so the routes are cut where they are read."""
    keys = with_number(asked).select(F.col("service").alias("service_provider"), "route_id").distinct()
    numbered = routes.withColumn("route_id", F.col("route_id").cast("bigint"))
    return lookup_join(numbered, keys, ["service_provider", "route_id"], "left_semi", check_size=True)


def _last_before(log: CommitLog, batch_id: int) -> int:
    """The last key of the batches before this one, which may be the one that ran last."""
    batch, before, last = log.state().notes.get("last", [-1, 0, 0])
    return before if batch == batch_id else last


def write_booking_batch(
    requests: DataFrame, batch_id: int, routes: DataFrame, out: str, now: Column | None = None
) -> None:
    """Results of one batch, then its booked rows, then its last key.

    Keys go on after those of earlier batches, so a batch run again writes the same keys in the same folders.
    """
    spark = requests.sparkSession
    asked = requests.persist()
    try:
        # A batch that only moves the watermark has no requests; without rows Spark does not read the routes.
        own = asked.limit(0) if asked.isEmpty() else asked
        replace_batch(book(own, _asked_routes(own, routes), now), f"{out}/results", batch_id)
    finally:
        asked.unpersist()
    results = spark.read.parquet(f"{out}/results/batch_id={batch_id}")
    log = CommitLog(spark, f"{out}/keys")
    before = _last_before(log, batch_id)
    replace_batch(booked_rows(results, before, stored=True), f"{out}/booked", batch_id)
    booked = spark.read.schema("id BIGINT").parquet(f"{out}/booked/batch_id={batch_id}").count()
    log.commit("keys", batch_id, [], notes={"last": [batch_id, before, before + booked]})


def start_bookings(
    requests: DataFrame,
    routes: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    delay: str = "10 minutes",
    now: Column | None = None,
) -> StreamingQuery:
    """Results go to `out`/results and booked rows to `out`/booked, one folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_booking_batch(batch, batch_id, routes, out, now)

    writer = first_requests(requests, delay).writeStream.option("checkpointLocation", checkpoint)
    return with_trigger(writer.outputMode("append").foreachBatch(write), trigger).start()
