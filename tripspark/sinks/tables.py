"""Parquet targets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.functions.times import day_of_micros


def ensure_table(spark: SparkSession, name: str, schema: str, path: str) -> None:
    """Create the table when it does not exist; a second call changes nothing."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING PARQUET LOCATION '{path}'")


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def replace_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch to its own folder; the same batch written again replaces it."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def has_batches(spark: SparkSession, path: str) -> bool:
    """Whether anything was written by `replace_batch` yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


NO_DAY = date(1, 1, 1)  # the day of rows without time: before every cutoff, so they expire with the next run


def by_day(spans: DataFrame, time: str = "start_ts") -> DataFrame:
    return spans.withColumn("day", F.coalesce(day_of_micros(F.col(time)), F.to_date(F.lit("0001-01-01")))).hint("rebalance", "day")


def write_by_day(spans: DataFrame, path: str, batch_id: int, time: str = "start_ts") -> None:
    """Store rows by UTC day, so time ranges and retention read whole folders or skip them.

    Each batch has a folder of its own below each day: late rows join what their day has, and a batch written again
    replaces itself alone. The rebalance hint lets Spark split a large day over several tasks.
    """
    (
        by_day(spans, time)
        .withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .partitionBy("day", "batch_id")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def write_day_table(spans: DataFrame, table: str, batch_id: int, time: str = "start_ts") -> None:
    """The same as a catalog table."""
    spark = spans.sparkSession
    rows = by_day(spans, time).withColumn("batch_id", F.lit(batch_id))
    if not spark.catalog.tableExists(table):
        rows.limit(0).write.partitionBy("day", "batch_id").saveAsTable(table)
    columns = spark.table(table).columns
    rows.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)


def write_links(links: DataFrame, path: str) -> None:
    """Daily link counts (day, parent, child, call_count). A day that is counted again replaces its earlier counts."""
    links.write.mode("overwrite").partitionBy("day").option("partitionOverwriteMode", "dynamic").parquet(path)


def expire_days(spark: SparkSession, table: str, cutoff: date) -> list[date]:
    """Drop the days before `cutoff`, and rows without time, from a table written by day. Only the list of days is read."""
    parts = [dict(p.split("=", 1) for p in row["partition"].split("/")) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    old = [p for p in parts if p["day"][:1].isdigit() and date.fromisoformat(p["day"]) < cutoff]
    for p in old:
        whole = f"day = DATE '{p['day']}', batch_id = {p['batch_id']}"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({whole})")
    return sorted({date.fromisoformat(p["day"]) for p in old})


def day_range(stored: DataFrame, start: int, end: int, time: str = "start_ts") -> DataFrame:
    """Rows of a table written by day within two times (microseconds); other days are not read."""
    days = F.col("day").between(
        day_of_micros(F.lit(start).cast("bigint")), day_of_micros(F.lit(end).cast("bigint"))
    )
    return stored.where(days & F.col(time).between(start, end))
