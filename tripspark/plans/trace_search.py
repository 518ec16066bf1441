"""Trace search over tables stored by day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripspark.operators.tracestore import insert_ignore, matching_spans, with_annotation_pages
from tripspark.session import stage
from tripspark.sources.daystore import MAX_IDS, DayStore
from tripspark.operators.skew import is_small


def traces_by_ids_stored(spans: DayStore, annotations: DayStore, ids: DataFrame) -> DataFrame:
    """Spans of the traces, with nested annotations; of both tables only days that may hold them are read."""
    return with_annotation_pages(spans.of_traces(ids), annotations.of_traces(ids))


def find_traces_stored(
    spans: DayStore, annotations: DayStore, start: int | None = None, end: int | None = None, **conditions
) -> DataFrame:
    """All spans of the traces in which some span meets the conditions of `matching_spans`.

    Only the days between `start` and `end` are searched. The traces found there, and the annotations of spans that may
    match, are looked up by trace.
    """
    of_spans = {k: conditions[k] for k in ("name", "min_duration", "max_duration", "ignore_case") if k in conditions}
    of_notes = {k: conditions[k] for k in ("service", "key", "a_type", "ignore_case") if k in conditions}
    found = stage(matching_spans(spans.between(start, end), None, start=start, end=end, **of_spans), "matching-spans")
    if set(of_notes) - {"ignore_case"}:
        found = matching_spans(found, annotations.of_traces(found), **of_notes)
    return spans.of_traces(found)


def insert_ignore_stored(new: DataFrame, store: DayStore) -> DataFrame:
    """Rows of `new` to store: none whose key (the store's) is there already, and one per key.

    Keys that no day may hold are new without looking further; of the stored rows only days and batches that may hold one
    of the others are read. A NULL in the key equals nothing.
    """
    rows = stage(new, "new-rows")
    keys = rows.select(*store.keys).dropna().distinct()
    hits = stage(store.hits(keys, is_small(keys, MAX_IDS)), "possible-keys")
    parts = store.parts_in(hits)
    possible = hits.select(*store.keys).distinct()
    stored = store.of_parts(parts).select(*store.keys).join(possible, store.keys, "left_semi")
    return insert_ignore(rows, stored, store.keys)
