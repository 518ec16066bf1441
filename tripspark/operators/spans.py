"""Spans with their annotations, and time-series points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.functions.text import text_or_empty
from tripspark.functions.times import time_of_micros
from tripspark.functions.traces import ipv6_text, port_number
from tripspark.operators.skew import fanout_left_join, lookup_join
from tripspark.vocabulary import TEXT_TYPE

SPAN_KEY = ["trace_id_high", "trace_id", "id"]
ROW_COLUMNS = [
    "trace_id", "span_id", "parent_id", "name", "endpoint_service_name", "endpoint_port", "a_key", "a_value", "a_type",
    "endpoint_ipv4", "endpoint_ipv6", "start_ts", "a_timestamp", "duration",
]
LEDGER_KEY = ["trace_id_high", "trace_id", "span_id", "a_timestamp", "a_key", "a_value"]
TEXT_FIELDS = ["name", "a_key", "a_value", "endpoint_ipv6", "endpoint_service_name"]
ANNOTATION_FIELDS = [
    "trace_id", "span_id", "a_key", "a_value", "a_type", "endpoint_ipv4", "endpoint_ipv6", "endpoint_port",
    "endpoint_service_name",
]


def unscanned(df: DataFrame) -> DataFrame:
    """Rows not copied yet; a NULL mark counts as neither."""
    return df.where(~F.col("scanned"))


def readable_annotations(annotations: DataFrame) -> DataFrame:
    """Annotation values as text, ports as unsigned numbers, addresses as hexadecimal text."""
    return annotations.select(
        "trace_id_high",
        "trace_id",
        "span_id",
        "a_key",
        F.col("a_value").cast("string").alias("a_value"),
        "a_type",
        "a_timestamp",
        "endpoint_ipv4",
        ipv6_text(F.col("endpoint_ipv6")).alias("endpoint_ipv6"),
        port_number(F.col("endpoint_port")).alias("endpoint_port"),
        "endpoint_service_name",
    )


def span_rows(
    spans: DataFrame, annotations: DataFrame, parity: bool = False, use_high: bool = False, own_id: str | None = None
) -> DataFrame:
    """Uncopied spans left joined with their annotations.

    Spans without annotations stay. Their `span_id` is the span's own id, or NULL with `parity`. The join
    ignores the high half of the trace id unless `use_high` is set. `own_id` names a further column for the span's own id.
    """
    keys = [*(["trace_id_high"] if use_high else []), "trace_id", "id"]
    left = unscanned(spans).select(*keys, "parent_id", "name", "start_ts", "duration")
    right = readable_annotations(annotations).withColumns({"id": F.col("span_id")})
    if not use_high:
        right = right.drop("trace_id_high")
    joined = fanout_left_join(left, right, keys)
    if not parity:
        joined = joined.withColumn("span_id", F.coalesce("span_id", "id"))
    return joined.select(*ROW_COLUMNS, *([F.col("id").alias(own_id)] if own_id else []))


def _point_fields(rows: DataFrame, names: list[str]) -> list[Column]:
    return [
        (text_or_empty(F.col(n)) if n in TEXT_FIELDS else F.coalesce(F.col(n), F.lit(0))).alias(n) for n in names
    ]


def to_points(rows: DataFrame, parity: bool = False, more: tuple[str, ...] = ()) -> DataFrame:
    """Points from joined span rows: `time`, fields without NULLs, the counter `a_number`, and columns in `more` as they are.

    A row without `a_timestamp` takes the span's start and is left out when that is missing too; with
    `parity` it takes the epoch.
    """
    micros = F.coalesce("a_timestamp", F.lit(0) if parity else "start_ts").cast("bigint")
    fields = [c for c in ROW_COLUMNS if c != "a_timestamp"]
    return (
        rows.withColumn("time_us", micros)
        .where(F.col("time_us").isNotNull())
        .select(
            "time_us",
            time_of_micros(F.col("time_us")).cast("timestamp_ntz").alias("time"),
            *_point_fields(rows, fields),
            F.lit(1).alias("a_number"),
            *more,
        )
    )


def annotation_points(annotations: DataFrame, parity: bool = False) -> DataFrame:
    """Points from uncopied annotations; those without time are left out, or put at the epoch with `parity`."""
    rows = readable_annotations(unscanned(annotations))
    micros = F.coalesce("a_timestamp", F.lit(0)) if parity else F.col("a_timestamp")
    return (
        rows.withColumn("time_us", micros.cast("bigint"))
        .where(F.col("time_us").isNotNull())
        .select(
            "time_us",
            time_of_micros(F.col("time_us")).cast("timestamp_ntz").alias("time"),
            *_point_fields(rows, ANNOTATION_FIELDS),
        )
    )


def last_write_wins(points: DataFrame) -> DataFrame:
    """The stored state when points of equal time overwrite each other.

    Arrival order is not recorded: the greatest (trace_id, span_id, a_key, a_value) counts as last, then
    the remaining fields. The greatest row is kept by aggregation, so equal times combine before the shuffle.
    """
    lead = ["trace_id", "span_id", "a_key", "a_value"]
    rest = [c for c in points.columns if c not in [*lead, "time_us"]]
    return (
        points.groupBy("time_us")
        .agg(F.max(F.struct(*lead, *rest)).alias("_last"))
        .select("time_us", "_last.*")
        .select(*points.columns)
    )


def span_ledger(spans: DataFrame) -> DataFrame:
    """Keys of copied spans, one row per span."""
    return spans.select(*SPAN_KEY).distinct()


def annotation_ledger(annotations: DataFrame) -> DataFrame:
    """Keys of copied annotations. NULL times and values are part of the key."""
    return annotations.select(*LEDGER_KEY).distinct()


def unprocessed_spans(spans: DataFrame, ledger: DataFrame) -> DataFrame:
    return spans.join(ledger, SPAN_KEY, "left_anti")


def unprocessed_annotations(annotations: DataFrame, ledger: DataFrame) -> DataFrame:
    """Compares NULLs as equal, so annotations without value or time are marked too."""
    key = F.struct(*LEDGER_KEY).alias("_key")  # fields of equal structs may be NULL
    return lookup_join(annotations.select("*", key), ledger.select(key), ["_key"], "left_anti").drop("_key")


def with_tag(spans: DataFrame, key: str, value: Column) -> DataFrame:
    """Annotation rows that add the text tag `key` to every span; spans with a NULL value get none."""
    return spans.select(
        "trace_id_high",
        "trace_id",
        F.col("id").alias("span_id"),
        F.lit(key).alias("a_key"),
        value.cast("string").alias("a_value"),
        F.lit(TEXT_TYPE).alias("a_type"),
        F.col("start_ts").alias("a_timestamp"),
    ).where(F.col("a_value").isNotNull())
