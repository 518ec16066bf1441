"""Expressions over span and annotation columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trace_key(high: Column, low: Column) -> Column:
    return F.struct(high.alias("trace_id_high"), low.alias("trace_id"))


def trace_key_text(high: Column, low: Column) -> Column:
    """32 hexadecimal digits: 16 of the high half, 16 of the low half."""
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def port_number(port: Column) -> Column:
    """Ports are kept in 16 signed bits, so those above 32767 arrive negative."""
    return F.pmod(port.cast("int"), F.lit(65536))


def ipv6_text(address: Column) -> Column:
    return F.lower(F.hex(address))


def in_sample(trace_id: Column, fraction: float) -> Column:
    """True for whole traces: the choice depends on the trace id alone.

    The first 12 hexadecimal digits of the id's MD5 are a number that SQL engines agree on, below 2^48.
    """
    drawn = F.conv(F.substring(F.md5(trace_id.cast("string")), 1, 12), 16, 10).cast("bigint")
    return drawn < F.lit(round(fraction * (1 << 48)))


def folded(value: Column, ignore_case: bool) -> Column:
    return F.lower(value) if ignore_case else value
