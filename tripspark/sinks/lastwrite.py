"""Points stored as they come, of which the last one written at a time counts."""

from __future__ import annotations

from collections import defaultdict
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tripspark.functions.times import day_of_micros
from tripspark.operators.spans import last_write_wins
from tripspark.sinks.commits import CommitLog, Folder

COMPACT_AT = 4


class LastWriteTable:
    """Batches of points, sorted by time within days and merged when they are read.

    Of equal times the later run counts, within a run the rule of `last_write_wins`. Compaction rewrites the days that have
    many batches as one, and leaves the others alone.
    """

    def __init__(self, log: CommitLog, table: str, schema: StructType):
        self.log, self.table, self.schema = log, table, schema
        self._stored = StructType([*schema.fields]).add("_run", LongType())

    def _write(self, rows: DataFrame, run: int, base: bool) -> list[Folder]:
        """One folder per day. `rows` has each time once; the rebalance hint splits a large day over tasks."""
        folder = f"{self.table}/run={run}-{'base' if base else 'more'}-{self.log.state().number}"
        dealt = rows.withColumn("day", day_of_micros(F.col("time_us"))).hint("rebalance", "day")
        path = f"{self.log.path}/{folder}"
        dealt.sortWithinPartitions("day", "time_us").write.mode("overwrite").partitionBy("day").parquet(path)
        days = self.log.spark.read.schema("day date").parquet(path).select("day").distinct().collect()  # from the folders' names
        return [Folder(self.table, f"{folder}/day={r['day']}", run, str(r["day"]), base) for r in days]

    def write(self, points: DataFrame, run: int) -> None:
        """Add a run's points; a run that is committed already changes nothing."""
        if not self.log.done(self.table, run):
            rows = last_write_wins(points.select(*self.schema.fieldNames())).withColumn("_run", F.lit(run).cast("bigint"))
            self.log.commit(self.table, run, self._write(rows, run, False))

    def _merged(self, folders: list[Folder]) -> DataFrame:
        rows = self.log.read_paths([f"{self.log.path}/{f.path}" for f in folders], self._stored)
        names = [c for c in self.schema.fieldNames() if c != "time_us"]
        last = F.max_by(F.struct(*names, "_run"), F.col("_run")).alias("_last")  # a run has each time once
        return rows.groupBy("time_us").agg(last).select("time_us", "_last.*")

    def read(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """The stored state, or that of some days, whose folders alone are read."""
        low, high = str(start or date.min), str(end or date.max)
        folders = [f for f in self.log.folders(self.table) if low <= f.part <= high]
        return self._merged(folders).select(*self.schema.fieldNames())

    def compact(self, at: int = COMPACT_AT) -> list[str]:
        """Rewrite the days that have at least `at` folders; returns them."""
        by_day: dict[str, list[Folder]] = defaultdict(list)
        for folder in self.log.folders(self.table):
            by_day[folder.part].append(folder)
        old = [f for folders in by_day.values() if len(folders) >= max(2, at) for f in folders]
        if not old:
            return []
        run = max(f.run for f in old)
        self.log.commit(f"{self.table}-compact", run, self._write(self._merged(old), run, True), old)
        return sorted({f.part for f in old})
