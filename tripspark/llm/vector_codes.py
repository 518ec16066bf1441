"""Product quantisation of vectors, with exact ball k-means.

Components become whole numbers, floor(scale * x); vectors are cut into equal parts, each with a codebook of its own that
starts as that part of the vectors with the smallest ids. Each round assigns every part to the nearest entry and moves each
entry to the floor of its parts' mean.

Ball k-means. A part keeps its entry from round to round; the parts of an entry lie in a ball around it, whose radius is
carried on from the last round's largest distance plus the entry's move. Then, with D the distance of two entries:
- an entry with D > 2 radius can't be nearest to any part of the ball; the others are the ball's neighbours;
- a part nearer than D / 2 to its entry, for all neighbours, is in the stable core and stays without another distance;
- neighbours stand in order of D; a part whose distance lies in the ring between D / 2 of two of them is compared with the
  neighbours inside only;
- if neither an entry nor a neighbour has moved, its ball stays as it is.
All tests are on squared whole numbers and keep ties (to the lower index), so the codes are those of the plain method.

Spark. Vectors travel in blocks of one Arrow batch: ids, labels, the packed vectors and their current codes. A round reads
the blocks with codebook and radii, writes them with new codes, and drops the blocks of the round before; a block's sums,
counts and largest distances are added up by place. Only codebook-sized rows reach the driver. What is
written lies in the shared folder, so a lost executor costs the tasks it ran.

Cases: rows whose vector is null, empty, or holds a null or a value that is not finite are dropped, and so are vectors of another length
than the one with the smallest id, which can't be cut alike. Lengths that the parts don't divide are filled up with zeros. Whole numbers stop at the
bound that keeps squared distances in 64 bits (over 10^8 for 64 components). With fewer vectors than entries the codebook is
smaller. Equal ids are rows of their own, ordered by vector; null ids come last. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm.frames import named
from tripspark.session import fresh_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096


@dataclass
class Balls:
    """What a round needs to know: entries (part, entry, place), bounds of the radii, and which entries moved."""

    entries: np.ndarray
    radii: np.ndarray  # infinite: nothing is known
    moved: np.ndarray

    def nearest(self, part: int, vectors: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """New codes and squared distances of one part of many vectors."""
        entries, moved = self.entries[part], self.moved[part]
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        best = ((vectors - entries[codes]) ** 2).sum(axis=1)
        new = codes.copy()
        order = np.argsort(codes, kind="stable")
        edges = np.searchsorted(codes[order], np.arange(len(entries) + 1))
        for own in range(len(entries)):
            rows = order[edges[own] : edges[own + 1]]
            if not len(rows):
                continue
            others = np.delete(np.arange(len(entries)), own)
            near = others[np.sqrt(gaps[own, others].astype(np.float64)) <= 2 * self.radii[part, own]]
            if not len(near) or not (moved[own] or moved[near].any()):
                continue
            near = near[np.argsort(gaps[own, near], kind="stable")]
            reach = np.searchsorted(gaps[own, near], 4 * best[rows], side="right")  # neighbours inside each part's ring
            for k, entry in enumerate(near.tolist()):
                ring = rows[reach > k]
                if not len(ring):
                    break
                away = ((vectors[ring] - entries[entry]) ** 2).sum(axis=1)
                wins = (away < best[ring]) | ((away == best[ring]) & (entry < new[ring]))
                best[ring[wins]], new[ring[wins]] = away[wins], entry
        return new, best


def _bound(width: int) -> int:
    return int((2.0**61 / width) ** 0.5 / 2)


def _kept(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows that can be coded."""
    values = named(vector).cast("array<double>")
    rows = vectors.withColumn("_values", values).where(F.size("_values") > 0)
    return rows.where(F.forall("_values", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))


def _whole(values: np.ndarray, width: int, scale: int) -> np.ndarray:
    bound = _bound(width)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -bound, bound).astype(np.int64)


def _padded(matrix: np.ndarray, parts: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, -matrix.shape[1] % parts)))


def _packed(matrix: np.ndarray) -> bytes:
    """In the narrowest type that holds the numbers; the length tells which."""
    most = int(np.abs(matrix).max(initial=0))
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    return matrix.astype(kind).tobytes()


def _unpacked(data: bytes, rows: int, places: int) -> np.ndarray:
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(data) // (rows * places)]
    return np.frombuffer(data, dtype=kind).reshape(rows, places).astype(np.int64)


BLOCK = "n int, ids array<{id}>, labels array<{label}>, vectors binary, codes binary"
SUMS = "sums array<bigint>, far array<bigint>"


def _blocks(rows: DataFrame, length: int, parts: int, scale: int) -> DataFrame:
    """Blocks of rows (_id, _label, _values), with every code at 0."""
    kinds = dict(rows.dtypes)
    places = length + -length % parts

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            values = batch.column(2)
            flat = values.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), length)
            whole = _padded(_whole(flat, places // parts, scale), parts)
            ends = pa.array([0, len(batch)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([len(batch)], pa.int32()),
                    pa.ListArray.from_arrays(ends, batch.column(0)),
                    pa.ListArray.from_arrays(ends, batch.column(1)),
                    pa.array([_packed(whole)], pa.binary()),
                    pa.array([bytes(len(batch) * parts)], pa.binary()),
                ],
                names=["n", "ids", "labels", "vectors", "codes"],
            )

    return rows.mapInArrow(made, BLOCK.format(id=kinds["_id"], label=kinds["_label"]))


def _assigned(n: int, vectors: bytes, codes: bytes, balls: Balls) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts, entries, width = balls.entries.shape
    own = _unpacked(vectors, n, parts * width).reshape(n, parts, width)
    old = np.frombuffer(codes, dtype=np.uint8).reshape(n, parts).astype(np.int64)
    found = [balls.nearest(j, own[:, j], old[:, j]) for j in range(parts)]
    return own, np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _moved_on(blocks: DataFrame, balls: Balls) -> DataFrame:
    """Blocks with new codes, and of each the sums, counts and largest distances by part and entry."""
    parts, entries, width = balls.entries.shape
    kinds = {f.name: f.dataType for f in blocks.schema.fields}
    schema = ", ".join(f"{n} {kinds[n].simpleString()}" for n in ("n", "ids", "labels", "vectors", "codes")) + ", " + SUMS

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1)
                n = row.column("n")[0].as_py()
                own, new, away = _assigned(n, row.column("vectors")[0].as_py(), row.column("codes")[0].as_py(), balls)
                sums = np.zeros((parts, entries, width), dtype=np.int64)
                counts, far = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
                for j in range(parts):
                    np.add.at(sums[j], new[:, j], own[:, j])
                    counts[j] = np.bincount(new[:, j], minlength=entries)
                    np.maximum.at(far[j], new[:, j], away[:, j])
                told = [np.concatenate((sums.ravel(), counts.ravel())).tolist()], [far.ravel().tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[row.column(c) for c in ("n", "ids", "labels", "vectors")],
                        pa.array([new.astype(np.uint8).tobytes()], pa.binary()),
                        *[pa.array(t, pa.list_(pa.int64())) for t in told],
                    ],
                    names=["n", "ids", "labels", "vectors", "codes", "sums", "far"],
                )

    return blocks.select("n", "ids", "labels", "vectors", "codes").mapInArrow(made, schema)


def _totals(blocks: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums (of any size), counts and largest squared distances over all blocks: as many rows as a codebook has numbers."""
    parts, entries, width = shape
    added = blocks.select(F.posexplode("sums")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(20,0)")).alias("v"))
    most = blocks.select(F.posexplode("far")).groupBy("pos").agg(F.max("col").cast("decimal(30,0)").alias("v"))
    rows = added.withColumn("k", F.lit(0)).unionByName(most.withColumn("k", F.lit(1))).collect()
    total = np.zeros(parts * entries * (width + 1), dtype=object)
    far = np.zeros(parts * entries, dtype=object)
    for r in rows:
        (far if r["k"] else total)[r["pos"]] = int(r["v"])
    edge = parts * entries * width
    return total[:edge].reshape(shape), total[edge:].reshape(parts, entries), far.reshape(parts, entries)


def _next(balls: Balls, sums: np.ndarray, counts: np.ndarray, far: np.ndarray) -> Balls:
    entries = balls.entries.copy()
    used = counts > 0
    entries[used] = (sums[used] // counts[used][:, None]).astype(np.int64)
    step = np.sqrt(((entries - balls.entries) ** 2).sum(axis=2).astype(np.float64))
    radii = (np.sqrt(far.astype(np.float64)) + step) * (1 + 1e-9) + 1e-6  # a little more than exact
    return Balls(entries, radii, step > 0)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _dropped(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def coded(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, label, codes, error), codes as an array by part, and the codebooks as numbers (part, entry, place)."""
    spark = vectors.sparkSession
    kept = _kept(vectors, vector).select(named(key).alias("_id"), named(label).alias("_label"), "_values")
    kinds = dict(kept.dtypes)
    first = kept.orderBy(F.col("_id").asc_nulls_last(), "_values").limit(entries).select("_id", "_values").collect()
    length = len(first[0]["_values"]) if first else parts
    kept = kept.where(F.size("_values") == length)
    if any(len(r["_values"]) != length for r in first):  # the first of those that are left
        first = kept.orderBy(F.col("_id").asc_nulls_last(), "_values").limit(entries).select("_id", "_values").collect()
    width = -(-length // parts)
    start = _whole(np.array([r["_values"] for r in first], dtype=np.float64).reshape(len(first), length), width, scale)
    book = np.ascontiguousarray(_padded(start, parts).reshape(len(first), parts, width).transpose(1, 0, 2))
    unknown = np.full((parts, len(first)), np.inf), np.ones((parts, len(first)), dtype=bool)
    balls = Balls(book, *unknown)
    blocks, path = _blocks(kept, length, parts, scale), None
    for _ in range(rounds if first else 0):
        new, written = _written(_moved_on(blocks, balls), "vector-blocks")
        if path:
            _dropped(spark, path)
        blocks, path = new, written
        balls = _next(balls, *_totals(blocks, balls.entries.shape))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                n = batch.column("n")[k].as_py()
                _, new, away = _assigned(n, batch.column("vectors")[k].as_py(), batch.column("codes")[k].as_py(), balls)
                ends = pa.array(np.arange(0, n * parts + 1, parts), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids").slice(k, 1).flatten(),
                        batch.column("labels").slice(k, 1).flatten(),
                        pa.ListArray.from_arrays(ends, pa.array(new.ravel(), pa.int32())),
                        pa.array(away.sum(axis=1), pa.int64()),
                    ],
                    names=["id", "label", "codes", "error"],
                )

    schema = f"id {kinds['_id']}, label {kinds['_label']}, codes array<int>, error long"
    found, _ = _written(blocks.select("n", "ids", "labels", "vectors", "codes").mapInArrow(made, schema), "vector-codes")
    if path:
        _dropped(spark, path)
    return found, balls.entries
