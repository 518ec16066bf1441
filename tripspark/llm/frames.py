"""Small helpers that the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.session import stage as stored  # noqa: F401

WORD = "[^ \t-\r]+"


def named(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_text(name: str = "text") -> Column:
    return F.coalesce(named(name), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
