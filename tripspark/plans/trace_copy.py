"""Copy of spans and annotations to time-series points, with a ledger of what was copied."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripspark.operators.spans import (
    SPAN_KEY, annotation_ledger, annotation_points, span_ledger, span_rows, to_points, unprocessed_annotations,
    unprocessed_spans, unscanned,
)
from tripspark.session import stage
from tripspark.sinks.commits import CommitLog
from tripspark.sinks.ledger import BUCKETS, MERGE_AT, Ledger
from tripspark.sinks.points import to_line_protocol, write_points
from tripspark.sources.daystore import DayStore, known_parts, noted_parts
from tripspark.vocabulary import ANNOTATION_MEASUREMENT, SPAN_MEASUREMENT


def copy_spans(
    spans: DataFrame,
    annotations: DataFrame,
    points_path: str,
    ledger_path: str,
    ledger: DataFrame | None = None,
    parity: bool = False,
    use_high: bool = False,
) -> None:
    """Write points of spans not copied yet, then their keys.

    Both come from one stored set of new rows, so what arrives meanwhile waits for the next run. Points come first: a run that stops between the two writes sends them again, and equal points overwrite each other.
    """
    new = stage(spans if ledger is None else unprocessed_spans(spans, ledger), "new-spans")
    write_points(to_points(span_rows(new, annotations, parity, use_high), parity), SPAN_MEASUREMENT, points_path)
    span_ledger(unscanned(new)).write.mode("append").parquet(ledger_path)


def copy_annotations(
    annotations: DataFrame, points_path: str, ledger_path: str, ledger: DataFrame | None = None, parity: bool = False
) -> None:
    """The same for annotations."""
    new = stage(annotations if ledger is None else unprocessed_annotations(annotations, ledger), "new-annotations")
    write_points(annotation_points(new, parity), ANNOTATION_MEASUREMENT, points_path)
    annotation_ledger(unscanned(new)).write.mode("append").parquet(ledger_path)


# Runs whose lines and ledger appear together


def span_keys(log: CommitLog, spans: DataFrame, buckets: int = BUCKETS, merge_at: int = MERGE_AT) -> Ledger:
    return Ledger(log, "span_keys", spans.select(*SPAN_KEY).schema, ["trace_id"], buckets, merge_at)


def annotation_keys(log: CommitLog, annotations: DataFrame, buckets: int = BUCKETS, merge_at: int = MERGE_AT) -> Ledger:
    schema = annotation_ledger(annotations).schema
    return Ledger(log, "annotation_keys", schema, ["trace_id"], buckets, merge_at)


def run_span_copy(
    spans: DataFrame, annotations: DataFrame, log: CommitLog, run: int, use_high: bool = False, ledger: Ledger | None = None
) -> None:
    """Lines (`lines`) of the spans that no earlier run has copied.

    Lines and keys are committed together. A run that stops before leaves nothing that readers see, and is done again
    with the same number; after the commit the same number changes nothing.
    """
    if log.done("span-copy", run):
        return
    ledger = ledger or span_keys(log, spans)
    new = stage(ledger.unprocessed(unscanned(spans)), "new-spans")
    lines = to_line_protocol(to_points(span_rows(new, annotations, use_high=use_high)), SPAN_MEASUREMENT)
    added = [log.write(lines, "lines", run, form="text"), ledger.addition(new, run)]
    log.commit("span-copy", run, added)
    ledger.merge("span-keys")


def run_annotation_copy(annotations: DataFrame, log: CommitLog, run: int, ledger: Ledger | None = None) -> None:
    """The same for annotations."""
    if log.done("annotation-copy", run):
        return
    ledger = ledger or annotation_keys(log, annotations)
    new = stage(ledger.unprocessed(unscanned(annotations)), "new-annotations")
    lines = to_line_protocol(annotation_points(new), ANNOTATION_MEASUREMENT)
    added = [log.write(lines, "annotation_lines", run, form="text"), ledger.addition(new, run)]
    log.commit("annotation-copy", run, added)
    ledger.merge("annotation-keys")


# Copy from tables stored by day


def run_stored_copy(spans: DayStore, annotations: DayStore, log: CommitLog, run: int) -> None:
    """Lines of the days and batches that came since the last run, late annotations included.

    New spans are sent with all their annotations. An annotation that came after its span was copied is sent with that
    span, which is looked up in the days that hold its trace. What has been copied is remembered by day and batch, so
    neither span keys nor copied days are read. The join uses the stores' keys: both halves of the trace id or the lower.
    """
    if log.done("stored-copy", run):
        return
    old = {name: known_parts(log, name) for name in ("spans", "annotations")}
    now = {"spans": spans.parts(), "annotations": annotations.parts()}
    new = {name: [p for p in now[name] if p not in old[name]] for name in now}
    use_high = "trace_id_high" in spans.keys
    fresh = stage(unscanned(spans.of_parts(new["spans"])), "new-spans")
    rows = span_rows(fresh, annotations.of_traces(fresh, now["annotations"]), use_high=use_high)
    if old["spans"] and new["annotations"]:
        late = stage(annotations.of_parts(new["annotations"]), "new-annotations")
        copied = unscanned(spans.of_traces(late, sorted(old["spans"])))
        joined = span_rows(copied, late, use_high=use_high, parity=True)
        rows = rows.unionByName(joined.where("span_id IS NOT NULL"))  # without a late annotation nothing is new
    lines = log.write(to_line_protocol(to_points(rows), SPAN_MEASUREMENT), "lines", run, form="text")
    log.commit("stored-copy", run, [lines], notes={name: noted_parts(parts) for name, parts in now.items()})
