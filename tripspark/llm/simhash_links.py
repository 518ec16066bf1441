"""Near duplicates by SimHash fingerprints, linked through covering locality-sensitive hashing.

Fingerprint: 64 bits from the XXH64 (seed 42) of a text's 3-word shingles, repeats included; a bit is 1 if over half of the
hashes have it. Fingerprints link when at most `RADIUS` bits differ.

Covering masks. Every bit gets one of the 2^(r+1) - 1 non-zero vectors of r+1 bits, in turn. For each non-zero vector v
there is a table whose mask has the bits whose vector has odd inner product with v. The vectors of r differing bits leave
some v orthogonal to all of them, so the mask of that v has none of these bits: every pair within the radius shares its
masked value in some table. Nothing is left to chance. For r = 2 there are 7 tables of 36 or 37 bits.

Buckets. Equal texts have one fingerprint, so tables hold distinct fingerprints only. A bucket (fingerprints of one masked
value in one table) of up to `LARGE` is searched in one task, which keeps only links that connect its groups: at most one
less than it has members, whatever the number of pairs. The fingerprints of a larger bucket agree in the mask's bits, so
their differences lie among the others; the covering of those bits splits the bucket further, again without losing a pair.
After two levels at most 12 bits are free, so no bucket can hold more than 4,096.

Cases: a null or empty text, or one without words, has the fingerprint zero, which links like any other. Below three words
the whole sequence is the one shingle. Rows with equal ids are rows of their own. A null id is never a component's smallest
id; a component of null ids alone has a null one. An empty table gives no rows. Long texts are read in pieces of `PIECE`
bytes. Other columns are not read by `grouped`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.components import components
from tripspark.llm.frames import named, stored
from tripspark.llm.text_blocks import SMALL_TABLE

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
LARGE = 1 << 13
PIECE = 1 << 20
BLANKS = b" \t\n\x0b\x0c\r"


# Fingerprints


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; no word is cut."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in BLANKS:
            end += 1
        yield text[at:end].split()
        at = end


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = len(words) - size + 1
    spans = zip(starts[:last].tolist(), ends[size - 1 :].tolist())
    return np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fingerprint(text: bytes | None) -> int:
    """As a signed 64-bit number."""
    held: list[bytes] = []
    ones, count = np.zeros(BITS, dtype=np.int64), 0
    for words in _pieces((text or b"").translate(SMALL_TABLE)):
        held += words
        if len(held) >= SHINGLE:
            hashes = _hashes(held, SHINGLE)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            count += len(hashes)
            held = held[1 - SHINGLE :]
    if not count and held:
        hashes = _hashes(held, len(held))
        ones, count = np.unpackbits(hashes.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, fp)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py()) for t in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    rows = docs.select(named(key).cast("long").alias("doc_id"), named(text).alias("text"))
    return rows.mapInArrow(made, "doc_id long, fp long")


# Covering


def covering(bits: list[int], radius: int) -> list[int]:
    """Masks over `bits`, as signed numbers: any `radius` of the bits are outside at least one mask."""
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, vectors + 1):
        mask = sum(1 << bit for k, bit in enumerate(bits) if ((k % vectors + 1) & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def _tables(masks: list[int]) -> Column:
    """One entry per mask: the number of the table and the masked fingerprint."""
    return F.array(*[F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("masked")) for i, m in enumerate(masks)])


def _apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Bits that differ; of a signed number numpy would count the bits of its absolute value."""
    return np.bitwise_count((one ^ other).view(np.uint64))


def _close_pairs(found: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected among different fingerprints: each is visited once and meets all not yet seen."""
    one, other = [], []
    rest = found
    while len(rest):
        wave, rest = [rest[0]], rest[1:]
        while wave and len(rest):
            seen = wave.pop()
            close = _apart(rest, seen) <= radius
            if close.any():
                near = rest[close]
                one.append(np.full(len(near), seen))
                other.append(near)
                wave.extend(near)
                rest = rest[~close]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *one]), np.concatenate([none, *other])


def _links(buckets: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) within buckets of bounded size; `buckets` has the key columns and fp.

    Buckets are sorted within partitions and read as a stream, so many small ones cost little.
    """
    keys = [c for c in buckets.columns if c != "fp"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            whole = np.concatenate(held)
            last = np.flatnonzero((whole[:, :-1] != whole[-1, :-1]).any(axis=1))
            upto = int(last[-1]) + 1 if len(last) else 0  # the last bucket may go on
            if upto:
                yield _linked(whole[:upto], radius)
            held = [whole[upto:]]
        if held and len(held[0]):
            yield _linked(held[0], radius)

    dealt = buckets.repartition(*keys).sortWithinPartitions(*keys, "fp")
    return dealt.select(*keys, "fp").mapInArrow(made, "u long, v long")


def _linked(rows: np.ndarray, radius: int) -> pa.RecordBatch:
    fp = rows[:, -1]
    opens = np.concatenate(([True], (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)))
    starts = np.flatnonzero(opens)
    sizes = np.diff(np.append(starts, len(rows)))
    two = starts[sizes == 2]
    two = two[_apart(fp[two], fp[two + 1]) <= radius]
    one, other = [fp[two]], [fp[two + 1]]
    for a, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        u, v = _close_pairs(fp[a : a + n], radius)
        one.append(u)
        other.append(v)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (one, other)], names=["u", "v"])


def links(distinct: DataFrame, radius: int = RADIUS, large: int = LARGE) -> DataFrame:
    """Links (u, v) that connect all fingerprints (fp, each once) within the radius of each other."""
    found, level, keys = [], distinct.select("fp"), []
    parents: list[list[int]] = [list(range(BITS))]
    while True:
        # The free bits of every table at this level, and the masks that cover them; the paths are fixed by the radius.
        masks = [covering(free, radius) for free in parents]
        table, masked = f"table{len(keys)}", f"masked{len(keys)}"
        path = F.lit(0)
        for k in keys:
            if k.startswith("table"):
                path = path * len(masks[0]) + F.col(k)
        choice = F.element_at(F.array(*[_tables(m) for m in masks]), path + 1)
        dealt = level.select(*keys, "fp", F.explode(choice).alias("t"))
        dealt = stored(dealt.select(*keys, F.col("t.table").alias(table), F.col("t.masked").alias(masked), "fp"), "covered")
        keys = [*keys, table, masked]
        sizes = dealt.groupBy(*keys).count().where("count > 1")
        # Buckets of one are most of them and have gone, so the sizes are few next to the members.
        shared = stored(dealt.join(sizes, keys), "buckets")
        parents = [[b for b in free if not m >> b & 1] for free, own in zip(parents, masks) for m in own]
        last = max(map(len, parents)) <= large.bit_length() - 1  # no more fingerprints than the free bits can tell apart
        small = shared if last else shared.where(F.col("count") <= large)
        found.append(stored(_links(small.drop("count"), radius), "links"))
        level = shared.where(F.col("count") > large).drop("count")
        if last or level.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, large: int = LARGE) -> DataFrame:
    """Rows (doc_id, fp, component_id), one per row of `docs`."""
    rows = stored(fingerprints(docs, key, text), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    groups = components(links(distinct, radius, large))
    named_groups = distinct.join(groups, distinct["fp"] == groups["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named_groups = stored(named_groups, "components")
    smallest = named_groups.groupBy("component").agg(F.min("least").alias("component_id"))
    answers = stored(named_groups.join(smallest, "component").select("fp", "component_id"), "answers")
    # Both sides are plain tables, so adaptive execution splits a fingerprint that very many rows have.
    return rows.join(answers, "fp", "left").select("doc_id", "fp", "component_id")
