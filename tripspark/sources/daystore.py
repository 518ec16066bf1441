"""Rows of traces stored by UTC day and batch, with a small index that tells which days can hold a trace.

Below `path`, `rows` has a folder per day and batch, `index` a folder per batch. The index holds, for each day of the batch,
Bloom filters of the traces in blocks of 32,768 bits, and the least and greatest trace id of each block. A trace belongs to
the block that its hash names; a day with 2^level times as many traces has 2^level blocks. A lookup asks one block per day,
and then reads only the days and batches that answered yes: false answers cost work, never rows.

The index of a batch is written before its rows, and a batch written again replaces both, so every row that can be read
can be found. One batch is written by one writer.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructType

from tripspark.functions.times import day_of_micros
from tripspark.operators.skew import lookup_join
from tripspark.session import stage
from tripspark.sinks.commits import CommitLog
from tripspark.sinks.tables import has_batches, write_by_day

TRACE = ["trace_id_high", "trace_id"]
BLOCK_BITS = 32_768  # of the bitmaps that bitmap_construct_agg makes
BITS_PER_TRACE = 12
PROBES = 6  # bits a trace sets: about one lookup in a hundred is a false yes
MAX_LEVEL = 20
MAX_IDS = 20_000  # ids that are asked by the index; more are found by a join with all rows

INDEX = "day date, level int, block long, bitmap binary, least long, most long, batch_id long"


class Part(NamedTuple):
    day: date
    batch_id: int


def noted_parts(parts: Iterable[Part]) -> list[list]:
    """As a note of a commit."""
    return [[p.day.isoformat(), p.batch_id] for p in sorted(parts)]


def known_parts(log: CommitLog, name: str) -> set[Part]:
    return {Part(date.fromisoformat(day), batch) for day, batch in log.state().notes.get(name, [])}


def trace_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("bigint") for k in keys])


def _block(hash: Column, level: Column) -> Column:
    return F.pmod(hash, F.pow(F.lit(2), level).cast("bigint"))


def _places(hash: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(hash, F.lit(j)), F.lit(BLOCK_BITS)) for j in range(PROBES)]


def _is_set(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1


def trace_index(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Index rows of one batch; `rows` has a day.

    Traces are counted per day before they become bits, and bits of a block are combined before the shuffle, so a day
    or a trace that holds most of the rows is no hot key.
    """
    last = F.col(keys[-1]).cast("bigint")
    traces = rows.groupBy("day", trace_hash(keys).alias("_hash")).agg(F.min(last).alias("least"), F.max(last).alias("most"))
    largest = traces.groupBy("day").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(1)).alias("n"))
    level = F.greatest(F.lit(0), F.ceil(F.log2(largest.scalar() * BITS_PER_TRACE / BLOCK_BITS))).cast("int")
    marked = traces.withColumn("level", F.least(level, F.lit(MAX_LEVEL)))
    return (
        marked.select("day", "level", _block(F.col("_hash"), F.col("level")).alias("block"), "least", "most",
                      F.explode(F.array(*_places(F.col("_hash")))).alias("place"))
        .groupBy("day", "level", "block")
        .agg(F.bitmap_construct_agg("place").alias("bitmap"), F.min("least").alias("least"), F.max("most").alias("most"))
    )


class DayStore:
    """Rows of `schema` below `path`, by the day of their `time` (microseconds); `keys` name the trace."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, time: str, keys: list[str] | None = None):
        self.spark, self.path, self.schema, self.time = spark, path.rstrip("/"), schema, time
        self.keys = TRACE if keys is None else keys

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Store a batch. Rows are staged first, so that index and rows are of the same ones."""
        rows = stage(rows.select(*self.schema.fieldNames()), "day-batch")
        day = F.coalesce(day_of_micros(F.col(self.time)), F.to_date(F.lit("0001-01-01")))
        index = trace_index(rows.select(*self.keys, day.alias("day")), self.keys)
        index.write.mode("overwrite").partitionBy("level").parquet(f"{self.path}/index/batch_id={batch_id}")
        write_by_day(rows, f"{self.path}/rows", batch_id, self.time)

    def stored(self) -> DataFrame:
        """Rows with `day` and `batch_id`, by which folders are left out."""
        schema = StructType([*self.schema.fields]).add("day", DateType()).add("batch_id", LongType())
        if not has_batches(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def index(self) -> DataFrame:
        if not has_batches(self.spark, f"{self.path}/index"):
            return self.spark.createDataFrame([], INDEX)
        return self.spark.read.schema(INDEX).parquet(f"{self.path}/index")

    def rows(self) -> DataFrame:
        return self.stored().select(*self.schema.fieldNames())

    def _folders(self, pattern: str) -> list[dict[str, str]]:
        """Names and values in the folders that match, without a job."""
        context = self.spark.sparkContext
        glob = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        found = glob.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(glob) or []
        paths = [f.getPath().toString().rsplit("/", pattern.count("/")) for f in found]
        return [dict(name.split("=", 1) for name in path[1:]) for path in paths]

    def parts(self) -> list[Part]:
        """Days and batches that have rows: as many as there are folders."""
        return sorted(Part(date.fromisoformat(f["day"]), int(f["batch_id"])) for f in self._folders("rows/day=*/batch_id=*"))

    def parts_in(self, rows: DataFrame) -> list[Part]:
        found = rows.select("day", "batch_id").distinct().collect()
        return sorted(Part(r["day"], r["batch_id"]) for r in found)

    def between(self, start: int | None, end: int | None) -> DataFrame:
        """Rows within two times, both included; other days are not read."""
        stored = self.stored()
        for bound, limit in ((start, lambda c, b: c >= b), (end, lambda c, b: c <= b)):
            if bound is not None:
                at = F.lit(bound).cast("bigint")
                stored = stored.where(limit(F.col("day"), day_of_micros(at)) & limit(F.col(self.time), at))
        return stored.select(*self.schema.fieldNames())

    def of_parts(self, parts: list[Part]) -> DataFrame:
        """Rows of some days and batches, read from their folders."""
        stored = self.stored()
        days, batches = sorted({p.day for p in parts}), sorted({p.batch_id for p in parts})
        some = stored.where(F.col("day").isin([F.to_date(F.lit(d.isoformat())) for d in days]) & F.col("batch_id").isin(batches))
        if len(parts) < len(days) * len(batches):  # not every batch has every day
            pair = F.concat_ws("/", F.col("day").cast("string"), F.col("batch_id").cast("string"))
            some = some.where(pair.isin([f"{p.day.isoformat()}/{p.batch_id}" for p in parts]))
        return some.select(*self.schema.fieldNames())

    def hits(self, ids: DataFrame, small: bool) -> DataFrame:
        """Of each trace in `ids` the days and batches that may hold it: (keys, day, batch_id).

        Every id meets one block per day and batch. The ids are broadcast if `small`, else dealt by block.
        """
        index = self.index()
        levels = sorted({int(f["level"]) for f in self._folders("index/batch_id=*/level=*")})  # at most MAX_LEVEL + 1
        asked = ids.dropna(subset=self.keys).select(*self.keys, trace_hash(self.keys).alias("_hash"))
        asked = asked.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
        asked = asked.withColumn("block", _block(F.col("_hash"), F.col("level")))
        last = F.col(self.keys[-1]).cast("bigint")
        met = index.join(F.broadcast(asked) if small else asked, ["level", "block"])
        met = met.where(last.between(F.col("least"), F.col("most")))
        for place in _places(F.col("_hash")):
            met = met.where(_is_set(F.col("bitmap"), place))
        return met.select(*self.keys, "day", "batch_id")

    def of_traces(self, ids: DataFrame, among: Iterable[Part] | None = None) -> DataFrame:
        """Rows of the traces in `ids`, all or those in some days and batches.

        Up to MAX_IDS ids are looked up in the index, and only the days that may hold one are read. With more, nearly every
        day would be; then all rows are joined.
        """
        asked = ids.select(*self.keys).distinct()
        few = asked.limit(MAX_IDS + 1).collect()
        if len(few) > MAX_IDS:
            rows = self.rows() if among is None else self.of_parts(list(among))
            return lookup_join(rows, asked, self.keys, "left_semi").select(*self.schema.fieldNames())
        asked = F.broadcast(self.spark.createDataFrame(few, asked.schema))
        found = self.parts_in(self.hits(asked, True)) if few else []
        wanted = found if among is None else sorted({*found} & {*among})
        return self.of_parts(wanted).join(asked, self.keys, "left_semi").select(*self.schema.fieldNames())
