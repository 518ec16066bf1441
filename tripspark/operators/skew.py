"""Joins that stay even when one key holds a large share of the rows.

Adaptive execution splits a large partition only where both join inputs come straight from a
shuffle, and never on the optional side of an outer join. The joins below cover the rest: they look
for heavy keys first and spread only those. Without heavy keys the plan is the plain join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

HOT_PARTITIONS = 2.0  # a key is heavy when it has more rows than this many average partitions ...
HOT_ROWS = 1_000_000  # ... and at least this many
SMALL_ROWS = 100_000  # tables up to this size may be broadcast
MOST_LISTED = 65_536  # keys that a summary lists: the function that makes them follows at most a million, eight for each

HotKeys = dict[int, float]  # hash of a heavy key -> share of the rows


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_hash(df: DataFrame, keys: list[str]) -> Column:
    """Equal for equal keys, also when whole numbers have different widths on the two sides of a join."""

    def wide(name: str) -> Column:
        return F.col(name).cast("bigint") if isinstance(df.schema[name].dataType, IntegralType) else F.col(name)

    return F.xxhash64(*[wide(k) for k in keys])


_FOUND: dict[tuple, HotKeys] = {}


def _summaries(hashes: DataFrame, partitions: int, listed: int) -> DataFrame:
    """The most frequent hashes of each group of tasks, and the rows of the group."""
    followed = 1 << math.ceil(math.log2(8 * listed))
    return hashes.groupBy(F.pmod(F.spark_partition_id(), F.lit(partitions)).alias("_tasks")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(hash, {listed}, {followed})").alias("top")
    )


def hot_keys(df: DataFrame, keys: list[str]) -> HotKeys:
    """Hashes of heavy keys, from one pass over the key columns.

    Each task sums up its keys, groups of tasks merge their summaries, and the heavy keys of the groups are added up by
    key: no task sees more summaries than there are tasks per shuffle partition. A summary follows several times as many
    keys as can be heavy, so a heavy key is in the list of every group where it has its share. Counts are estimates: a
    wrong one changes how rows are spread, never the rows. The answer is kept for the same table, keys and size of files.
    """
    partitions = _partitions(df)
    hashes = df.select(key_hash(df, keys).alias("hash"))
    size = str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())  # a path that is written again
    known = (df.sparkSession.sparkContext.applicationId, hashes.semanticHash(), size, partitions, HOT_ROWS, HOT_PARTITIONS)
    if known not in _FOUND:
        # With very many partitions a key has to be somewhat larger than two of them to be found.
        share = min(0.25, max(HOT_PARTITIONS / partitions, 2 / MOST_LISTED))
        groups = _summaries(hashes, partitions, math.ceil(2 / share)).persist()
        try:
            total = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
            least = max(HOT_ROWS, share * total)
            heavy = (
                groups.select(F.explode("top").alias("t"))
                .groupBy(F.col("t.item").alias("hash"))
                .agg(F.sum("t.count").alias("n"))
                .where(F.col("n") > least)
                .collect()  # fewer than 1 / share rows
            )
        finally:
            groups.unpersist()
        if len(_FOUND) >= 1000:
            _FOUND.clear()
        _FOUND[known] = {r["hash"]: r["n"] / total for r in heavy}
    return _FOUND[known]


def is_hot(df: DataFrame, keys: list[str], hot: HotKeys) -> Column:
    return key_hash(df, keys).isin(*hot)


def is_small(df: DataFrame, rows: int | None = None) -> bool:
    """Counts at most one row more than the bound."""
    bound = SMALL_ROWS if rows is None else rows
    return df.limit(bound + 1).count() <= bound


def _salt_count(df: DataFrame, hot: HotKeys) -> int:
    """Pieces about as large as an average partition."""
    return max(2, math.ceil(_partitions(df) * max(hot.values())))


def _has_map(kind: DataType) -> bool:
    """Maps, and what holds them, have no hash."""
    return "map<" in kind.simpleString()


def _spread(df: DataFrame, heavy: Column, salts: int) -> DataFrame:
    # The task number keeps equal rows apart; a task run again puts its rows in the same places.
    hashed = [f.name for f in df.schema.fields if not _has_map(f.dataType)]
    piece = F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.lit(salts)).cast("int")
    return df.withColumn("_salt", F.when(heavy, piece).otherwise(F.lit(0)))


def _repeat(df: DataFrame, heavy: Column, salts: int) -> DataFrame:
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    return df.withColumn("_salt", F.explode(F.when(heavy, every).otherwise(F.array(F.lit(0)))))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    check_size: bool = False,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join many rows per key on the left with at most one on the right.

    `how` is inner, left, left_semi or left_anti; for the last two the right side may repeat keys. With `check_size`
    the right side is counted, up to the bound, and broadcast when it is small; set it where that is cheap next to a
    shuffle of the left side. Where the left side takes long to compute, heavy keys can be looked for in `keys_from`,
    an earlier form of it with the same keys.
    """
    if check_size and is_small(right):
        return left.join(F.broadcast(right), keys, how)
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys).distinct()
    hot = hot_keys(left if keys_from is None else keys_from, keys)
    if not hot:
        return left.join(right, keys, how)
    salts = _salt_count(left, hot)
    spread = _spread(left, is_hot(left, keys, hot), salts)
    repeated = _repeat(right, is_hot(right, keys, hot), salts)
    return spread.join(repeated, [*keys, "_salt"], how).drop("_salt")


def fanout_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left outer join of one row per key with any number of rows per key."""
    right = right.dropna(subset=keys)  # such rows have no partner
    hot = hot_keys(right, keys)
    if not hot:
        return left.join(right, keys, "left")
    salts = _salt_count(right, hot)
    heavy_right = is_hot(right, keys, hot)
    # As many rows as there are heavy hashes, so at most about the number of partitions.
    heavy_keys = right.where(heavy_right).select(*keys).distinct().withColumn("_heavy", F.lit(True))
    marked = left.join(F.broadcast(heavy_keys), keys, "left")
    joined = _repeat(marked, F.col("_heavy").isNotNull(), salts).join(
        _spread(right, heavy_right, salts).withColumn("_found", F.lit(True)), [*keys, "_salt"], "left"
    )
    # A heavy key has rows on the right, so its copies without a partner are leftovers of the spreading.
    kept = F.col("_found").isNotNull() | F.col("_heavy").isNull()
    return joined.where(kept).drop("_salt", "_found", "_heavy")
