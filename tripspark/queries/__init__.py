"""Queries over the order and event tables, each with an SQL twin where SQL can express it."""

from tripspark.queries import access, bookings, integrity, jobs, stored, streams, traces, trips  # noqa: F401
from tripspark.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
