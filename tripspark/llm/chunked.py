"""Questions from chunks of documents to a table dealt by hash, and the answers back to the chunks.

Some operators need, for every place of every text, something that only the whole corpus knows: how often an n-gram
occurs, or whether a string occurs elsewhere. Documents are dealt into chunks; a chunk asks about many hashes at once, one
packed cell per hash bucket; a bucket answers every cell in its order; the answers go back to the chunk, which has its
documents at hand. Chunks and buckets have bounded sizes, and there are more of them with more data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.frames import named
from tripspark.llm.packed import bucket_count

CHUNK = "chunk int, cell binary"
ASKED = "bucket int, chunk int, part int, cell binary"
ANSWERED = "chunk int, part int, bucket int, cell binary"
NOTE = 0  # a part that a chunk sends to itself: passed on as it is
LEAST_CHUNK = 1 << 18


def text_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(named(text))), F.lit(0)).alias("n")).first()["n"]


def chunk_count(df: DataFrame, text: str, chunk_bytes: int, total: int | None = None) -> int:
    """Chunks of about that size; smaller ones where that keeps more tasks busy."""
    total = text_bytes(df, text) if total is None else total
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-total // chunk_bytes), min(partitions, total // LEAST_CHUNK))


def bucket_count_of(df: DataFrame, total: int, bucket_bytes: int) -> int:
    """Buckets for the hashes of `total` bytes of text, none for much more than `bucket_bytes` of them.

    The setting for shuffles asks for more, smaller ones, but not so small that a cell holds next to nothing.
    """
    return max(1, -(-total // bucket_bytes), min(bucket_count(df.sparkSession), total // LEAST_CHUNK))


def chunk_cells(df: DataFrame, key: str, text: str, count: int) -> DataFrame:
    """Rows (chunk, cell): documents dealt by the hash of id and text, compressed."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= 32 << 20:
                yield _by_chunk(held)
                held, size = [], 0
        if held:
            yield _by_chunk(held)

    rows = df.select(
        F.pmod(F.xxhash64(named(key).cast("long"), named(text)), F.lit(count)).cast("int").alias("chunk"),
        named(key).cast("long").alias("doc_id"),
        named(text).alias("text"),
    )
    return rows.mapInArrow(made, CHUNK)


def _by_chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks().sort_by("chunk")
    chunk = table.column("chunk").to_numpy()
    starts = np.flatnonzero(np.diff(chunk, prepend=-1))
    squeeze = zstandard.ZstdCompressor(level=3)
    cells = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(chunk)]):
        sink = pa.BufferOutputStream()
        own = table.slice(a, b - a).select(["doc_id", "text"]).combine_chunks()
        with pa.ipc.new_stream(sink, own.schema) as out:
            out.write_table(own)
        cells.append(squeeze.compress(sink.getvalue()))
    return pa.RecordBatch.from_arrays([pa.array(chunk[starts], pa.int32()), pa.array(cells, pa.binary())], names=["chunk", "cell"])


def documents(cells: pa.ChunkedArray) -> pa.Table:
    """The documents of a chunk (doc_id, text) in an order that doesn't depend on how the cells came."""
    opened = zstandard.ZstdDecompressor()
    parts = [pa.ipc.open_stream(opened.decompress(cell.as_py())).read_all() for cell in cells]
    whole = pa.concat_tables(parts)
    whole = whole.set_column(1, "text", whole.column("text").cast(pa.large_string()))
    return whole.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()


def squeezed(columns: list[np.ndarray]) -> bytes:
    """Equally long columns, byte plane by byte plane, so that planes of equal bytes vanish."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def opened(cell: bytes, kinds: list[str]) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), dtype=np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, found = len(raw) // sum(widths), 0, []
    for kind, width in zip(kinds, widths):
        planes = raw[at : at + n * width].reshape(width, n)
        found.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return found


@dataclass
class Question:
    """Rows of a chunk in a fixed order, each for one bucket."""

    part: int
    bucket: np.ndarray

    def __post_init__(self) -> None:
        self.order = np.argsort(self.bucket, kind="stable")
        self.own, starts = np.unique(self.bucket[self.order], return_index=True)
        self.ranges = list(zip(starts.tolist(), [*starts[1:].tolist(), len(self.order)]))

    def rows(self, chunk: int, columns: list[np.ndarray], steps: tuple[int, ...] = ()) -> list[tuple[int, int, int, bytes]]:
        """One cell per bucket; the columns numbered in `steps` are written as differences."""
        dealt = [c[self.order] for c in columns]
        rows = []
        for bucket, (a, b) in zip(self.own.tolist(), self.ranges):
            parts = [np.diff(c[a:b], prepend=c.dtype.type(0)) if i in steps else c[a:b] for i, c in enumerate(dealt)]
            rows.append((bucket, chunk, self.part, squeezed(parts)))
        return rows

    def answers(self, table: pa.Table, kind: str) -> np.ndarray:
        """The answers in the order of the rows."""
        cells = {}
        for part, bucket, cell in zip(*(table.column(c).to_pylist() for c in ("part", "bucket", "cell"))):
            if part == self.part:
                cells[bucket] = cell
        found = np.zeros(len(self.order), dtype=kind)
        for bucket, (a, b) in zip(self.own.tolist(), self.ranges):
            (own,) = opened(cells[bucket], [kind])
            if len(own) != b - a:
                raise ValueError("an answer doesn't fit its question")
            found[self.order[a:b]] = own
        return found


def note(chunk: int, buckets: int, values: np.ndarray) -> tuple[int, int, int, bytes]:
    return chunk % buckets, chunk, NOTE, squeezed([values])


def note_of(table: pa.Table, kind: str) -> np.ndarray:
    for part, cell in zip(table.column("part").to_pylist(), table.column("cell").to_pylist()):
        if part == NOTE:
            return opened(cell, [kind])[0]
    return np.zeros(0, dtype=kind)


def asked_table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    kinds = (("bucket", pa.int32()), ("chunk", pa.int32()), ("part", pa.int32()), ("cell", pa.binary()))
    return pa.table({name: pa.array(list(c), kind) for c, (name, kind) in zip(columns, kinds)})


def answered(asked: DataFrame, kinds: list[str], answer, steps: tuple[int, ...] = ()) -> DataFrame:
    """`answer` gets the columns of all cells of a bucket and gives one column; each cell gets its part of it."""

    def made(table: pa.Table) -> pa.Table:
        notes = table.filter(pc.equal(table.column("part"), NOTE))
        real = table.filter(pc.not_equal(table.column("part"), NOTE))
        cells: list[bytes] = []
        if len(real):
            read = [opened(c.as_py(), kinds) for c in real.column("cell")]
            for columns in read:
                for i in steps:
                    columns[i] = np.cumsum(columns[i], dtype=columns[i].dtype)
            sizes = [len(columns[0]) for columns in read]
            whole = answer(*[np.concatenate([columns[i] for columns in read]) for i in range(len(kinds))])
            cells = [squeezed([np.ascontiguousarray(own)]) for own in np.split(whole, np.cumsum(sizes)[:-1])]
        answers = real.set_column(real.column_names.index("cell"), "cell", pa.array(cells, pa.binary()))
        return pa.concat_tables([notes, answers]).select(["chunk", "part", "bucket", "cell"])

    return asked.groupBy("bucket").applyInArrow(made, ANSWERED)
