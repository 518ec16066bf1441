"""Positions, predecessors and dense keys without sorting a large group in one task."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.operators.skew import hot_keys, is_hot
from tripspark.session import stage


def number_in_groups(
    df: DataFrame, group: list[str], chunk: list[Column], order: list[str], name: str = "row_no"
) -> DataFrame:
    """Zero-based position in the group's order.

    `chunk` must follow the order and bound the rows of one chunk; group and chunk must not be NULL. Rows are
    sorted per chunk, and each chunk is shifted by the number of rows before it. `df` is read twice, the second
    time for the keys only, so it should be a stored table or a cheap view of one.
    """
    marks = [f"_chunk{i}" for i in range(len(chunk))]
    marked = df.withColumns(dict(zip(marks, chunk)))
    keys = [*group, *marks]
    before = Window.partitionBy(*group).orderBy(*marks).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        marked.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (
        marked.withColumn("_local", local)
        .join(shifts, keys, "left")
        .withColumn(name, F.col("_local") + F.col("_before"))
        .select(*df.columns, name)
    )


def previous_in_group(
    df: DataFrame, group: list[str], order: list[str], value: str, name: str, chunk: Column
) -> DataFrame:
    """Value of the row before, in the group's order; NULL on the first row.

    Heavy groups are cut by `chunk`, which must follow the order; a chunk's first row takes the last
    value of the chunk before it.
    """
    hot = hot_keys(df, group)
    if not hot:
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(*group).orderBy(*order)))
    heavy = F.coalesce(is_hot(df, group, hot), F.lit(False))
    marked = df.withColumns({"_heavy": heavy, "_chunk": F.when(heavy, chunk)})
    keys = [*group, "_heavy", "_chunk"]
    window = Window.partitionBy(*keys).orderBy(*order)
    # Rows without place in the order make a chunk of their own, the first one.
    starts = (
        marked.where("_heavy")
        .groupBy(*keys)
        .agg(F.max_by(value, F.struct(*order)).alias("_last"))
        .select(*keys, F.lag("_last").over(Window.partitionBy(*group).orderBy("_chunk")).alias("_before"))
        .alias("s")
    )
    local = marked.withColumns({"_local": F.lag(value).over(window), "_at": F.row_number().over(window)}).alias("m")
    same = reduce(lambda a, b: a & b, [F.col(f"m.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    before = F.when(F.col("m._at") == 1, F.col("s._before")).otherwise(F.col("m._local"))
    return local.join(starts, same, "left").select(*[F.col(f"m.{c}") for c in df.columns], before.alias(name))


def with_dense_keys(df: DataFrame, order: list[str], name: str = "id", start: int = 0, stored: bool = False) -> DataFrame:
    """Keys start+1, start+2, ... in the given order.

    The rows are stored, unless they come from a stored table, range-partitioned and stored again with their place, as the
    range partitioning reads its input twice; only the row count of each partition reaches the driver. Rows that the order leaves equal, such as all those
    without id, are told apart by where they are stored, so they need not fit in one range.
    """
    ranges = [*order, "_stored"]
    numbered = df.withColumn("_stored", F.monotonically_increasing_id())
    unplaced = numbered if stored else stage(numbered, "unplaced")
    ranged = unplaced.repartitionByRange(*ranges).sortWithinPartitions(*ranges)
    placed = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), "dense-keys")
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    shifts = [(row["_part"], shift) for row, shift in zip(counts, accumulate([start] + [r["n"] for r in counts]))]
    offsets = df.sparkSession.createDataFrame(shifts, "_part BIGINT, _shift BIGINT")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(
            (F.col("_shift") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(name), *df.columns
        )
    )
