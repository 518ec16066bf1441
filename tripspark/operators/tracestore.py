"""Queries over stored spans and annotations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tripspark.functions.text import service_url
from tripspark.functions.times import day_of_micros
from tripspark.functions.traces import folded, in_sample
from tripspark.operators.lists import PAGE_SIZE, pages
from tripspark.operators.skew import lookup_join
from tripspark.operators.spans import SPAN_KEY
from tripspark.vocabulary import EVENT_TYPE, MOBILITY_SUFFIX

TRACE = ["trace_id_high", "trace_id"]
ANNOTATION_SPAN = [*TRACE, "span_id"]
ANNOTATION_KEY = [*ANNOTATION_SPAN, "a_key", "a_timestamp"]


# Names and services


def service_names(annotations: DataFrame, ignore_case: bool = False) -> DataFrame:
    name = folded(F.col("endpoint_service_name"), ignore_case).alias("service_name")
    return annotations.where(F.col("endpoint_service_name").isNotNull()).select(name).distinct()


def service_catalogue(services: DataFrame, suffix: str = MOBILITY_SUFFIX) -> DataFrame:
    """Bookable services and the address of their route list."""
    return services.where(F.col("service_name").endswith(suffix)).select(
        "service_name", service_url(F.col("service_name")).alias("url")
    )


def span_services(annotations: DataFrame) -> DataFrame:
    """Service of each span: the name on its earliest annotation that has one, ties by name.

    Annotations without time come last.
    """
    return (
        annotations.where(F.col("endpoint_service_name").isNotNull())
        .groupBy(*ANNOTATION_SPAN)
        .agg(
            F.min_by(
                "endpoint_service_name", F.struct(F.col("a_timestamp").isNull(), "a_timestamp", "endpoint_service_name")
            ).alias("service")
        )
        .withColumnRenamed("span_id", "id")
    )


def with_service(spans: DataFrame, annotations: DataFrame) -> DataFrame:
    """Adds `service`; NULL where no annotation names one."""
    return spans.join(span_services(annotations), SPAN_KEY, "left")


def span_names(spans: DataFrame, ignore_case: bool = False) -> DataFrame:
    return spans.select(folded(F.col("name"), ignore_case).alias("name")).distinct()


def span_names_of_services(spans: DataFrame, annotations: DataFrame, ignore_case: bool = False) -> DataFrame:
    named = spans.select(*SPAN_KEY, "name").join(span_services(annotations), SPAN_KEY)
    return named.select(
        folded(F.col("service"), ignore_case).alias("service_name"), folded(F.col("name"), ignore_case).alias("name")
    ).distinct()


# Finding traces


def traces_by_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Spans, or annotations, of the traces in `ids` (trace_id_high, trace_id)."""
    return lookup_join(rows, ids.select(*TRACE), TRACE, "left_semi")


def with_annotation_pages(spans: DataFrame, annotations: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Spans with nested annotations in pages; a span without annotations has one page with an empty list."""
    items = ["a_timestamp", "a_key", "a_value", "a_type", "endpoint_service_name"]
    nested = pages(
        annotations.select(*TRACE, F.col("span_id").alias("id"), *items), SPAN_KEY, items, "annotations", page_size
    )
    return spans.join(nested, SPAN_KEY, "left").withColumns(
        {"page": F.coalesce("page", F.lit(0)), "annotations": F.coalesce("annotations", F.array())}
    )


def matching_spans(
    spans: DataFrame,
    annotations: DataFrame,
    name: str | None = None,
    service: str | None = None,
    key: str | None = None,
    a_type: int | None = None,
    start: int | None = None,
    end: int | None = None,
    min_duration: int | None = None,
    max_duration: int | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """Keys of spans that meet every condition given.

    `key` and `a_type` must hold on the same annotation. Times and durations are microseconds with both
    bounds included; a NULL never matches.
    """

    def equal(column: str, value: str) -> Column:
        return folded(F.col(column), ignore_case) == folded(F.lit(value), ignore_case)

    found = spans
    if name is not None:
        found = found.where(equal("name", name))
    if start is not None:
        found = found.where(F.col("start_ts") >= start)
    if end is not None:
        found = found.where(F.col("start_ts") <= end)
    if min_duration is not None:
        found = found.where(F.col("duration") >= min_duration)
    if max_duration is not None:
        found = found.where(F.col("duration") <= max_duration)
    found = found.select(*SPAN_KEY)
    if key is not None or a_type is not None:
        wanted = annotations
        if key is not None:
            wanted = wanted.where(equal("a_key", key))
        if a_type is not None:
            wanted = wanted.where(F.col("a_type") == a_type)
        marked = wanted.select(*TRACE, F.col("span_id").alias("id")).distinct()
        found = found.join(marked, SPAN_KEY, "left_semi")
    if service is not None:
        # Only spans that name the service at all can belong to it, so only their annotations are grouped.
        naming = annotations.where(equal("endpoint_service_name", service)).select(*ANNOTATION_SPAN).distinct()
        owners = span_services(annotations.join(naming, ANNOTATION_SPAN, "left_semi"))
        found = found.join(owners.where(equal("service", service)).select(*SPAN_KEY), SPAN_KEY, "left_semi")
    return found


def find_traces(spans: DataFrame, annotations: DataFrame, **conditions) -> DataFrame:
    """All spans of the traces in which some span meets the conditions of `matching_spans`."""
    return traces_by_ids(spans, matching_spans(spans, annotations, **conditions))


def traces_by_start(spans: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per trace, newest first. With `limit` Spark keeps only that many rows per task."""
    traces = (
        spans.groupBy(*TRACE)
        .agg(F.min("start_ts").alias("start_ts"), F.count(F.lit(1)).alias("spans"))
        .orderBy(F.desc("start_ts"), *TRACE)
    )
    return traces if limit is None else traces.limit(limit)


# Links and counts


def span_links(spans: DataFrame, annotations: DataFrame) -> DataFrame:
    """One row per child span whose service and parent's service are known and differ.

    Children of a parent are counted per day and service before the join, so a parent with very many
    children brings few rows.
    """
    services = span_services(annotations)
    children = (
        spans.where(F.col("parent_id").isNotNull())
        .select(*SPAN_KEY, "parent_id", "start_ts")
        .join(services, SPAN_KEY)
        .groupBy(*TRACE, "parent_id", day_of_micros(F.col("start_ts")).alias("day"), F.col("service").alias("child"))
        .agg(F.count(F.lit(1)).alias("calls"))
    )
    parents = spans.select(*SPAN_KEY).join(services, SPAN_KEY).select(
        *TRACE, F.col("id").alias("parent_id"), F.col("service").alias("parent")
    )
    return children.join(parents, [*TRACE, "parent_id"]).where(F.col("parent") != F.col("child"))


def dependency_links(spans: DataFrame, annotations: DataFrame) -> DataFrame:
    """Calls per UTC day of the child span, parent service and child service."""
    return (
        span_links(spans, annotations)
        .groupBy("day", "parent", "child")
        .agg(F.sum("calls").alias("call_count"))
    )


def point_counts(
    points: DataFrame, width: str = "1 minute", slide: str | None = None, quantiles: tuple[float, ...] = ()
) -> DataFrame:
    """Points per time window and service, with mean and largest duration; quantiles are approximate."""
    window = F.window("time", width, slide)
    extra = [
        F.percentile_approx("duration", q).alias(f"duration_p{round(q * 100)}") for q in quantiles
    ]
    return (
        points.groupBy(window.alias("_window"), F.col("endpoint_service_name").alias("service"))
        .agg(
            F.sum("a_number").alias("points"),
            (F.sum("duration") / F.count("duration")).alias("mean_duration"),
            F.max("duration").alias("max_duration"),
            *extra,
        )
        .select(F.col("_window.start").cast("timestamp_ntz").alias("window_start"), "*")
        .drop("_window")
    )


# Keeping and dropping rows


def insert_ignore(new: DataFrame, stored: DataFrame, keys: list[str], ignore_case: bool = False) -> DataFrame:
    """Rows of `new` to append: none with a stored key, and one per key, the smallest.

    Rows with a NULL in the key equal nothing and are all kept. With `ignore_case` texts in the key are compared
    without regard to case.
    """
    texts = {f.name for f in new.schema.fields if isinstance(f.dataType, StringType)}
    marks = {f"_key{i}": folded(F.col(k), ignore_case and k in texts) for i, k in enumerate(keys)}
    keyed = new.withColumns(marks)
    whole = reduce(lambda a, b: a & b, [F.col(m).isNotNull() for m in marks])
    one = (
        keyed.where(whole)
        .groupBy(*marks)
        .agg(F.min(F.struct(*new.columns)).alias("_row"))
        .join(stored.withColumns(marks).select(*marks), list(marks), "left_anti")
        .select("_row.*")
    )
    return one.unionByName(keyed.where(~whole).select(*new.columns))


def retain(spans: DataFrame, cutoff: int, column: str = "start_ts") -> DataFrame:
    """Rows not older than `cutoff` (microseconds); rows without time are dropped."""
    return spans.where(F.col(column) >= cutoff)


def sample_traces(spans: DataFrame, fraction: float) -> DataFrame:
    return spans.where(in_sample(F.col("trace_id"), fraction))


# Annotation kinds


def events_of(annotations: DataFrame) -> DataFrame:
    return annotations.where(F.col("a_type") == EVENT_TYPE)


def span_tags(annotations: DataFrame) -> DataFrame:
    """One row per span and tag key; of several values the smallest counts."""
    return (
        annotations.where(F.col("a_type") != EVENT_TYPE)
        .groupBy(*ANNOTATION_SPAN, "a_key")
        .agg(F.min(F.col("a_value").cast("string")).alias("a_value"))
    )


def span_tag_maps(annotations: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Tags of each span as a map, in pages."""
    tags = pages(span_tags(annotations), ANNOTATION_SPAN, ["a_key", "a_value"], "_tags", page_size)
    return tags.select(*ANNOTATION_SPAN, "page", F.map_from_entries("_tags").alias("tags"))
