"""Keys of what was processed, as a base and the additions of each run since, merged when there are enough of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tripspark.operators.skew import lookup_join
from tripspark.sinks.commits import CommitLog, Folder

BUCKETS = 64
MERGE_AT = 8


class Ledger:
    """Rows of `schema`, whose first `deal` columns say which bucket a key lies in.

    Each run adds the keys of its buckets in one folder. A run that looks for new rows reads the base and the additions
    since, and of both only the buckets that the rows fall into. Keys with NULL parts equal each other.
    """

    def __init__(self, log: CommitLog, table: str, schema: StructType, deal: list[str], buckets: int = BUCKETS, merge_at: int = MERGE_AT):
        self.log, self.table, self.schema, self.deal = log, table, schema, deal
        self.buckets, self.merge_at = buckets, merge_at

    def _bucket(self) -> Column:
        hash = F.xxhash64(*[F.col(c).cast("bigint") for c in self.deal])
        return F.pmod(hash, F.lit(self.buckets)).cast("int")

    def _stored(self, folders: list[Folder]) -> DataFrame:
        """Spark finds the bucket in the folders' names; each folder is a table of its own."""
        schema = StructType([*self.schema.fields]).add("bucket", IntegerType())
        rows = self.log.read_paths([], schema)
        for folder in folders:
            rows = rows.unionByName(self.log.spark.read.schema(schema).parquet(f"{self.log.path}/{folder.path}"))
        return rows

    def keys(self) -> DataFrame:
        return self._stored(self.log.folders(self.table)).select(*self.schema.fieldNames())

    def unprocessed(self, rows: DataFrame) -> DataFrame:
        """Rows whose key is not stored. `rows` is read twice: a stored table, best."""
        touched = [r["bucket"] for r in rows.select(self._bucket().alias("bucket")).distinct().collect()]  # at most `buckets`
        stored = self._stored(self.log.folders(self.table)).where(F.col("bucket").isin(touched))
        key = F.struct(*self.schema.fieldNames()).alias("_key")  # fields of equal structs may be NULL
        return lookup_join(rows.select("*", key), stored.select(key), ["_key"], "left_anti").drop("_key")

    def _write(self, keys: DataFrame, run: int, base: bool) -> Folder:
        folder = Folder(self.table, f"{self.table}/run={run}-{'base' if base else 'more'}-{self.log.state().number}", run, base=base)
        dealt = keys.select(*self.schema.fieldNames()).distinct().withColumn("bucket", self._bucket())
        dealt.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.log.path}/{folder.path}")
        return folder

    def addition(self, keys: DataFrame, run: int) -> Folder:
        """The keys of a run, to be committed with what the run wrote."""
        return self._write(keys, run, False)

    def merge(self, job: str, force: bool = False) -> bool:
        """Make a new base when there are `merge_at` additions. Done again after a stop, it starts anew."""
        folders = self.log.folders(self.table)
        more = [f for f in folders if not f.base]
        if not more or len(more) < self.merge_at and not force:
            return False
        base = self._write(self._stored(folders), max(f.run for f in more), True)
        self.log.commit(job, base.run, [base], folders)
        return True
