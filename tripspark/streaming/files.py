"""Stored rows as file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

EVERY_FIVE_SECONDS = {"processingTime": "5 seconds"}
UNTIL_DONE = {"availableNow": True}


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_trigger(writer: DataStreamWriter, trigger: dict[str, object] | None) -> DataStreamWriter:
    """A batch every five seconds unless told otherwise; a batch that takes longer delays the next."""
    return writer.trigger(**(trigger or EVERY_FIVE_SECONDS))
