"""Rows of numbers packed into binary cells, so that many millions of them go through a shuffle as few rows.

A cell holds equally long columns of fixed types for one bucket of a key. A task that has a chunk of texts makes one cell
per bucket that it has rows for; the shuffle brings the cells of a bucket together. With more data there are more buckets
and cells get smaller, down to one row each: no cell and no bucket grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = "bucket int, cell binary"
BUCKETS_PER_PARTITION = 2
Layout = dict[str, str]


def bucket_count(spark: SparkSession) -> int:
    """Several buckets per shuffle partition: the setting that says how finely the data is to be cut."""
    return BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by the upper half of evenly spread 64-bit keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def rising(keys: np.ndarray) -> np.ndarray:
    """np.argsort(keys, kind="stable") of evenly spread 64-bit keys, in a fraction of its time.

    One sort of plain numbers: the upper bits of a key and, below them, its place. Different keys of equal upper bits are
    few and are put in order afterwards.
    """
    n = len(keys)
    if n < 2:
        return np.arange(n)
    least = keys.min()
    width = int(keys.max() - least).bit_length()
    low = np.uint64((1 << (n - 1).bit_length()) - 1)
    both = ((keys - least) << np.uint64(min(64 - width, 63)) & ~low) | np.arange(n, dtype=np.uint64)
    both.sort()
    order = (both & low).astype(np.int64)
    own, upper = keys[order], both & ~low
    clash = np.unique(upper[1:][(upper[1:] == upper[:-1]) & (own[1:] != own[:-1])])
    if len(clash):
        starts, ends = np.searchsorted(upper, clash), np.searchsorted(upper, clash, side="right")
        places = np.concatenate([np.arange(a, b) for a, b in zip(starts.tolist(), ends.tolist())])
        order[places] = order[places][np.argsort(own[places], kind="stable")]
    return order


def packed(bucket: np.ndarray, columns: dict[str, np.ndarray], layout: Layout) -> pa.RecordBatch:
    """One cell per bucket; rows keep their order within it."""
    order = np.argsort(bucket, kind="stable")
    own, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    sorted_columns = [np.ascontiguousarray(columns[name][order], dtype=kind) for name, kind in layout.items()]
    cells = [b"".join(c[a:b].tobytes() for c in sorted_columns) for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(cells, pa.binary())], names=["bucket", "cell"])


def unpacked(cells: pa.ChunkedArray | pa.Array, layout: Layout) -> dict[str, np.ndarray]:
    """The rows of all cells, by column."""
    width = sum(np.dtype(kind).itemsize for kind in layout.values())
    parts: dict[str, list[np.ndarray]] = {name: [np.zeros(0, dtype=kind)] for name, kind in layout.items()}
    for cell in cells:
        raw = cell.as_buffer()
        n, at = raw.size // width, 0
        for name, kind in layout.items():
            parts[name].append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(columns) for name, columns in parts.items()}


class Packer:
    """Collects rows of several blocks and hands out cells when there are enough."""

    def __init__(self, layout: Layout, buckets: int, key: str, rows: int = 400_000):
        self.layout, self.buckets, self.key, self.rows = layout, buckets, key, rows
        self.held: list[dict[str, np.ndarray]] = []
        self.count = 0

    def add(self, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.count += len(columns[self.key])
        if self.count >= self.rows:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            whole = {name: np.concatenate([h[name] for h in self.held]) for name in self.layout}
            self.held, self.count = [], 0
            yield packed(bucket_of(whole[self.key].view(np.uint64), self.buckets), whole, self.layout)


def by_bucket(df: DataFrame, function, schema: str) -> DataFrame:
    """`function` turns the table of one bucket's cells into a table."""
    return df.groupBy("bucket").applyInArrow(function, schema)


BITS = 1 << 22
_WORD_BITS = 64


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % _WORD_BITS).cast("int"))


def with_mark(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str, into: str = "maybe") -> DataFrame:
    """`df` with a flag that is true for every row whose key is among `wanted`, and for few others.

    The keys become a bitmap of fixed size: at most BITS / 64 = 65,536 rows of two numbers, which is what gets broadcast,
    whatever the number of keys. It only spares other work: with very many keys all rows are flagged.
    """
    place = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(BITS))
    bits = (
        wanted.select(place(F.col(wanted_key)).alias("b"))
        .select(F.floor(F.col("b") / _WORD_BITS).alias("w"), _bit(F.col("b")).alias("m"))
        .groupBy("w")
        .agg(F.bit_or("m").alias("m"))
    )
    spot = place(F.col(key))
    flagged = df.withColumn("_w", F.floor(spot / _WORD_BITS)).join(
        F.broadcast(bits.select(F.col("w").alias("_w"), F.col("m").alias("_m"))), "_w", "left"
    )
    hit = F.coalesce(F.col("_m").bitwiseAND(_bit(spot)) != 0, F.lit(False))
    return flagged.withColumn(into, hit).drop("_w", "_m")
