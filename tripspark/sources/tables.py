"""Stored tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.schemas import struct_of


@dataclass(frozen=True)
class JdbcSource:
    """A database read in parallel: `bounds` is (column, lowest, highest, partitions)."""

    url: str
    bounds: tuple[str, int, int, int]
    table: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def options(self, name: str) -> dict[str, object]:
        column, lowest, highest, partitions = self.bounds
        return {
            "url": self.url,
            "table": self.table or name,
            "column": column,
            "lowerBound": lowest,
            "upperBound": highest,
            "numPartitions": partitions,
            # Times without zone arrive as what they are, so no cast stands between a filter and the database.
            "properties": {"preferTimestampNTZ": "true", **self.properties},
        }


def load_table(spark: SparkSession, name: str, source: str | JdbcSource) -> DataFrame:
    """Table `name` from a folder of Parquet tables or a database, with the columns of its schema by name.

    Filters on the result reach the Parquet scan or the database.
    """
    schema = struct_of(name)
    if isinstance(source, JdbcSource):
        stored = spark.read.jdbc(**source.options(name))
        kinds = dict(stored.dtypes)
        return stored.select(
            *[
                F.col(f.name) if kinds.get(f.name) == f.dataType.simpleString() else F.col(f.name).cast(f.dataType)
                for f in schema.fields
            ]
        )
    return spark.read.schema(schema).parquet(f"{source.rstrip('/')}/{name}")


def lookup(df: DataFrame, **values: object) -> DataFrame:
    """Rows where every named column equals its value."""
    condition: Column = F.lit(True)
    for name, value in values.items():
        condition = condition & (F.col(name) == F.lit(value))
    return df.where(condition)
