"""Time expressions. Epoch values are microseconds in UTC and the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_of_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def micros_of_time(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def day_of_time(time: Column) -> Column:
    return F.to_date(time)


def day_of_micros(micros: Column) -> Column:
    return F.to_date(F.timestamp_micros(micros))


def time_text(time: Column) -> Column:
    return F.date_format(time.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssz")


def now_seconds() -> Column:
    """One value per query."""
    return F.date_trunc("second", F.current_timestamp()).cast("timestamp_ntz")
