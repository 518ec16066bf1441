"""Routes stored by their pair of cities, so that a trip search doesn't shuffle them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.operators.routes import PAIR, ROUTE_COLUMNS
from tripspark.operators.skew import hot_keys, key_hash

BUCKETS = 64


class PairRoutes:
    """A catalog table of routes in buckets by pair, sorted within them.

    A pair with more routes than a bucket should hold is cut into pieces, which are part of the bucket's key; how many
    pieces a pair has is stored beside the table, for such pairs only.
    """

    def __init__(self, spark: SparkSession, table: str, path: str):
        self.spark, self.table, self.path = spark, table, path.rstrip("/")

    def write(self, routes: DataFrame, buckets: int = BUCKETS) -> None:
        """Replace the table. `routes` is read twice: a stored table, best."""
        rows = routes.select(*ROUTE_COLUMNS)
        hot = hot_keys(rows, PAIR)
        cuts = [(h, max(2, math.ceil(buckets * share))) for h, share in hot.items()]  # as many as heavy keys: a bounded number
        heavy = F.broadcast(self.spark.createDataFrame(cuts, "_hash long, pieces int"))
        hashed = rows.withColumn("_hash", key_hash(rows, PAIR)).join(heavy, "_hash", "left")
        piece = F.pmod(F.xxhash64("service_provider", "route_id"), F.coalesce("pieces", F.lit(1))).cast("int")
        dealt = hashed.withColumn("piece", piece).drop("_hash", "pieces")
        cut = hashed.where(F.col("pieces").isNotNull()).select(*PAIR, "pieces").distinct()
        cut.write.mode("overwrite").parquet(f"{self.path}/pieces")
        key = [*PAIR, "piece"]
        writer = dealt.repartition(buckets, *key).write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
        writer.option("path", f"{self.path}/routes").saveAsTable(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table).drop("piece")

    def of_pairs(self, pairs: DataFrame) -> DataFrame:
        """The routes of distinct pairs, with the pairs' columns. Only the pairs are dealt, heavy ones to every piece."""
        cut = self.spark.read.schema("origin int, destination int, pieces int").parquet(f"{self.path}/pieces")
        pieces = F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)
        asked = pairs.join(F.broadcast(cut), PAIR, "left").withColumn("piece", F.explode(pieces)).drop("pieces")
        return self.spark.table(self.table).join(asked, [*PAIR, "piece"]).drop("piece")
