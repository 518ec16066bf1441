"""Time-series points as text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, FractionalType, IntegralType


def _name(text: str) -> str:
    """Commas, spaces and equals signs in names are escaped."""
    for mark in (",", " ", "="):
        text = text.replace(mark, "\\" + mark)
    return text


def _text_value(value: Column) -> Column:
    """Quoted; backslashes and quotes are escaped and line breaks written as \\n, so a point is one line."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit('"'))


def _field_value(column: Column, kind: DataType) -> Column:
    """Whole numbers carry an i; other numbers and truth values stand as they are; all else is text."""
    if isinstance(kind, IntegralType):
        return F.concat(column.cast("string"), F.lit("i"))
    if isinstance(kind, (FractionalType, BooleanType)):
        return column.cast("string")
    return _text_value(column.cast("string"))


def to_line_protocol(
    points: DataFrame, measurement: str, time_col: str = "time_us", fields: list[str] | None = None
) -> DataFrame:
    """One `value` per point: measurement, fields, and the time in nanoseconds.

    `time_col` holds microseconds; `fields` are all other columns but `time` unless given. NULL fields, numbers that are
    no finite value, and points without any field or without time are left out, as the format has no form for them.
    """
    kinds = {f.name: f.dataType for f in points.schema.fields}
    chosen = [n for n in kinds if n not in ("time", time_col)] if fields is None else fields
    parts = []
    for name in chosen:
        column = F.col("`" + name.replace("`", "``") + "`")
        if isinstance(kinds[name], (FloatType, DoubleType)):
            column = F.when(~F.isnan(column) & (F.abs(column) != F.lit(float("inf"))), column)
        parts.append(F.concat(F.lit(f"{_name(name)}="), _field_value(column, kinds[name])))
    line = F.concat_ws(",", *parts)
    time = F.col("`" + time_col.replace("`", "``") + "`")
    return points.where(time.isNotNull() & (line != "")).select(
        F.concat(F.lit(f"{_name(measurement)} "), line, F.lit(" "), (time * 1000).cast("string")).alias("value")
    )


def write_points(points: DataFrame, measurement: str, path: str, mode: str = "append") -> None:
    to_line_protocol(points, measurement).write.mode(mode).text(path)
