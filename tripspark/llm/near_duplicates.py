"""N-gram Jaccard self-join with adaptive multi-match prefixes, and the groups its links form.

A document is the set of its distinct five-word shingles. Two link when 100 * shared >= 80 * union.

Shingles are ordered by hash. If two sets of n and m shingles link, they share at least t = ceil(80 n / 100) of them, so
the first n - t + l of one and the first m - t + l of the other share at least l, for every l. A document takes the
smallest l with which it may leave out its dearest l - 1 prefix shingles (those in more than `DEAR` documents) as probes
and still meet every partner by one of the others; in return a pair has to share more of the longer prefix before it is
verified. Passages that many documents share so cost nothing, as long as they make up a part of a document.

Steps:
1. `sets`: per document the number of shingles and a hash of the set. Equal sets are one node from here on.
2. `postings`: the longest prefix any l needs, dealt by shingle; only shingles of two or more nodes go on.
3. `members`: a node whose prefix is mostly shared belongs to the families of its three most frequent prefix shingles.
4. `family_links`: members of a family are dealt to blocks of about `FAMILY_BLOCK`, and some `PIVOTS` of them to every
   block. A block compares its members exactly, by the products of their shingle matrices, and gives the edges of a
   spanning forest only. So a text goes to one block per family, and thousands of copies of one original make as many edges
   as members, not all their pairs; the pivots connect the blocks.
5. `family_pairs`: members that those edges don't connect meet by their sketches, in blocks of numbers without texts.
   Members of a family's largest part meet the others only.
6. `probe_pairs`: probes meet all postings of their shingle, but not those of a common family, nor those that the families'
   edges already connect with them. Shared probes are counted per pair; a pair goes on if they can still add up to the
   overlap it needs.
7. `verified`: the whole sets of both texts, read again, decide about the pairs of steps 5 and 6.
8. Components over all edges.

A sketch has a bit per hash place, which is the parity of the set's shingles there. Every shingle that only one of two sets
has turns one bit, so sets whose sketches differ in more bits than linked sets may differ in shingles don't link: sketches
rule pairs out and never lose one. Those of step 5 are as wide as the set asks for, so they serve texts of any length;
those of step 6 have 256 bits and serve texts of up to some hundred words.

Numbers travel as packed cells (packed.py); texts are shuffled only for documents in a family or a pair. No cap on
partners, no cap on groups: where r of a family's g members are outside its largest part, sketches meet in r * g / WIDE^2
blocks, each a task's small part.

Cases: a null or empty text, or one without words, has an empty set and links with nothing. One to four words make one
shingle of all words. Rows with equal ids are one document with all their texts, and linked. Rows with a null id link with
nothing. Shingles are told apart by 64-bit hashes, and sets count as equal when a 64-bit hash of two sums over them and their
size agrees. An empty table gives no rows. Other columns are not read by `edges` and `grouped`, and pass through
`without_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.components import components
from tripspark.llm.frames import named, stored
from tripspark.llm.packed import CELL, Packer, bucket_count, by_bucket, packed, bucket_of, unpacked, with_mark
from tripspark.llm.text_blocks import NO_BLANKS, blocks, grams, mixed, whole_grams, words_of

SIZE = 5
DEAR = 24  # a shingle in more documents costs more than a longer prefix
FAMILY_BLOCK = 256
PIVOTS = 64
WIDE = 1024  # members of a block of sketches
SKETCH_BITS = 256

_POSTING = {"token": "u8", "node": "u8", "n": "i4", "pos": "i4"}
_SHARED = {**_POSTING, "df": "i4"}
_FAMILIES = ("family", "second", "third")
_SKETCH = tuple(f"bits{i}" for i in range(SKETCH_BITS // 64))
_PART = {"node": "u8", "part": "u8"} | {name: "u8" for name in _SKETCH}
_PROBE = {**_POSTING, "level": "i4", "use": "i4"} | {name: "u8" for name in (*_FAMILIES, "part", *_SKETCH)}


def needed(n: np.ndarray) -> np.ndarray:
    """The least overlap of a set of n with any partner."""
    return (80 * n + 99) // 100


def base_prefix(n: np.ndarray) -> np.ndarray:
    return n - needed(n) + 1


def most_levels(n: np.ndarray) -> np.ndarray:
    """How far a prefix may be lengthened: a tenth of the set, and a little."""
    return np.minimum(4 + n // 10, needed(n))


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the text, its distinct shingle hashes in order) for every text."""
    for block in blocks(texts):
        words = words_of(block, NO_BLANKS)
        hashes, places = grams(words, SIZE)
        short, short_places = whole_grams(words, SIZE)
        hashes = np.concatenate([hashes, short])
        doc = words.doc[np.concatenate([places, short_places])]
        order = np.argsort(doc, kind="stable")
        hashes, ends = hashes[order], np.cumsum(np.bincount(doc, minlength=len(block)))
        start = 0
        for i, end in enumerate(ends.tolist()):
            yield block.first + i, np.unique(hashes[start:end])
            start = end


def _node(shingles: np.ndarray) -> np.uint64:
    sums = np.array([np.sum(shingles, dtype=np.uint64), np.sum(mixed(shingles), dtype=np.uint64)])
    sums[1:] += np.uint64(len(shingles))
    return mixed(sums[:1] + mixed(sums[1:]))[0]


def sketch(shingles: np.ndarray, bits: int) -> bytes:
    """Parities of the numbers of shingles by place; `bits` is a power of two. The halves of a sketch add up to a narrower one."""
    places = (mixed(shingles) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def may_differ(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """In how many shingles linked sets of n and m may differ: each has 4 (n + m) / 9 at least of the other's."""
    return n + m + 2 * (-4 * (n + m) // 9)


def sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """Columns doc_id, n, node (a hash of the set; null for an empty one), sketch."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, bits = [], [], []
            for _, own in shingle_sets(batch.column(1)):
                sizes.append(len(own))
                nodes.append(int(_node(own).view(np.int64)) if len(own) else None)
                bits.append(sketch(own, SKETCH_BITS) if len(own) else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "node", "sketch"])

    rows = df.select(named(key).cast("long").alias("doc_id"), named(text).alias("x"))
    return rows.mapInArrow(made, "doc_id long, n long, node long, sketch binary")


def postings(df: DataFrame, text: str) -> DataFrame:
    """Cells of the longest prefixes, by shingle."""
    buckets = bucket_count(df.sparkSession)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Packer(_POSTING, buckets, "token")
        for batch in batches:
            for _, own in shingle_sets(batch.column(0)):
                n = len(own)
                if n:
                    size = np.int64(n)
                    k = int(min(base_prefix(size) + most_levels(size) - 1, n))
                    columns = {
                        "token": own[:k],
                        "node": np.full(k, _node(own)),
                        "n": np.full(k, n, dtype=np.int32),
                        "pos": np.arange(k, dtype=np.int32),
                    }
                    yield from out.add(columns)
        yield from out.rest()

    return df.select(named(text).alias("x")).mapInArrow(made, CELL)


def shared(cells: DataFrame) -> DataFrame:
    """Postings of shingles that two or more nodes have, with their number of nodes, by node."""
    buckets = bucket_count(cells.sparkSession)

    def made(table: pa.Table) -> pa.Table:
        rows = unpacked(table.column("cell"), _POSTING)
        order = np.lexsort((rows["node"], rows["token"]))
        token, node = rows["token"][order], rows["node"][order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        order = order[new]
        token = rows["token"][order]
        _, group, counts = np.unique(token, return_inverse=True, return_counts=True)
        df = counts[group]
        keep = df >= 2
        order = order[keep]
        own = {name: rows[name][order] for name in _POSTING} | {"df": df[keep]}
        return pa.Table.from_batches([packed(bucket_of(own["node"], buckets), own, _SHARED)])

    return by_bucket(cells, made, CELL)


def _choice(rows: dict[str, np.ndarray], dear_df: int) -> dict[str, np.ndarray]:
    """Level, probes and families of every node, for its rows in order."""
    order = np.lexsort((rows["pos"], rows["node"]))
    rows = {name: column[order] for name, column in rows.items()}
    node, n, pos, df = rows["node"], rows["n"].astype(np.int64), rows["pos"].astype(np.int64), rows["df"].astype(np.int64)
    if not len(node):
        return rows | {name: np.zeros(0, dtype=_PROBE[name]) for name in ("level", "use", *_FAMILIES)}
    _, first, group, size = np.unique(node, return_index=True, return_inverse=True, return_counts=True)
    # A partner may be a fifth smaller, and its stored prefix has to be long enough too.
    prefix, levels, longest = base_prefix(n), most_levels(needed(n)), base_prefix(n) + most_levels(n) - 1
    dear = df > dear_df
    before = np.cumsum(dear) - dear
    before = before - before[first][group]  # dear ones earlier in the same node
    met = dear & (pos - before < prefix)
    extra = np.minimum(np.bincount(group, weights=met).astype(np.int64)[group], levels - 1)
    inside = pos < prefix + extra
    # Among the dear ones of the prefix, the dearest `extra` are left out.
    cost = np.where(inside & dear, df, 0)
    by_cost = np.lexsort((-cost, group))
    rank = np.empty(len(node), dtype=np.int64)
    rank[by_cost] = np.arange(len(node)) - first[group]
    use = inside & ~((cost > 0) & (rank < extra))
    # Families: the three most frequent shingles, where at least half of the prefix is shared; 0 for none.
    by_df = np.lexsort((rows["token"], -df, group))
    mostly = 2 * size >= np.minimum(longest, n)[first]
    tops = {}
    for i, name in enumerate(_FAMILIES):
        top = rows["token"][by_df[np.minimum(first + i, len(node) - 1)]]
        tops[name] = np.where(mostly & (size > i), top, np.uint64(0))[group]
    return rows | {
        "level": (1 + extra).astype(np.int32),
        "use": use.astype(np.int32),
    } | tops


def part_cells(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """Cells of every node with its part of the graph, which is itself where no family linked it, and its sketch, by node."""
    buckets = bucket_count(nodes.sparkSession)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Packer(_PART, buckets, "node")
        for batch in batches:
            node, part = (batch.column(i).to_numpy().view(np.uint64) for i in range(2))
            bits = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint64).reshape(len(node), len(_SKETCH))
            yield from out.add({"node": node, "part": part} | {name: bits[:, i] for i, name in enumerate(_SKETCH)})
        yield from out.rest()

    return with_part(nodes, parts).select("node", "part", "sketch").mapInArrow(made, CELL)


def with_part(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """`rows` with the part of their node."""
    known = parts.select("node", F.col("component").alias("part"))
    return rows.join(known, "node", "left").withColumn("part", F.coalesce("part", "node"))


def chosen(shared_cells: DataFrame, nodes: DataFrame, parts: DataFrame, dear: int = DEAR) -> DataFrame:
    """Cells by shingle, with what each node chose, the families it is in, the part of the graph that those gave it, its sketch."""
    buckets = bucket_count(shared_cells.sparkSession)

    def made(table: pa.Table, known_cells: pa.Table) -> pa.Table:
        rows = _choice(unpacked(table.column("cell"), _SHARED), dear)
        known = unpacked(known_cells.column("cell"), _PART)
        order = np.argsort(known["node"])
        at = order[np.searchsorted(known["node"][order], rows["node"])]  # all nodes are known
        rows |= {name: known[name][at] for name in _PART if name != "node"}
        return pa.Table.from_batches([packed(bucket_of(rows["token"], buckets), rows, _PROBE)])

    return shared_cells.groupBy("bucket").cogroup(part_cells(nodes, parts).groupBy("bucket")).applyInArrow(made, CELL)


def members(shared_cells: DataFrame, dear: int = DEAR) -> DataFrame:
    """Rows (family, node): up to three families a node."""

    def made(table: pa.Table) -> pa.Table:
        rows = _choice(unpacked(table.column("cell"), _SHARED), dear)
        node, at = np.unique(rows["node"], return_index=True)
        family = np.concatenate([rows[name][at] for name in _FAMILIES])
        node = np.tile(node, len(_FAMILIES))[family != 0]
        return pa.table({"family": family[family != 0].view(np.int64), "node": node.view(np.int64)})

    return by_bucket(shared_cells, made, "family long, node long")


def sized(member_rows: DataFrame) -> DataFrame:
    """Stored rows (family, node, n) of families with several members."""
    member_rows = stored(member_rows, "members")
    sizes = member_rows.groupBy("family").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stored(member_rows.join(sizes, "family").select("family", "node", "n"), "families")


def family_links(member_rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges (x, y) that connect what links within blocks of each family; see `_forest`. `member_rows` has the family's size n."""
    blocks = F.ceil(F.col("n") / FAMILY_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    # Every member of a family of few is a pivot with a chance of PIVOTS / n: no order, no list of members is needed.
    pivot = F.pmod(F.xxhash64("family", "node"), F.col("n")) < PIVOTS
    targets = F.when(pivot, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
    dealt = member_rows.join(texts, "node").select("family", F.explode(targets).alias("block"), "node", "text")
    # Blocks are dealt evenly, also those of one large family.
    together = dealt.repartition("family", "block").sortWithinPartitions("family", "block", "node")
    return together.mapInArrow(_forests, "x long, y long").distinct()


def family_pairs(member_rows: DataFrame, texts: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (x, y) of a family of several blocks that may link, by their sketches, and lie in different parts."""
    large = stored(with_part(member_rows.where(F.col("n") > FAMILY_BLOCK), parts), "large-families")
    sizes = large.groupBy("family", "part").agg(F.count(F.lit(1)).alias("own"))
    sizes = sizes.groupBy("family").agg(
        F.max_by("part", F.struct("own", "part")).alias("main"), F.max("own").alias("most"), F.sum("own").alias("all")
    )
    count = lambda rows: F.ceil(rows / WIDE).cast("int")
    sizes = sizes.where("most < all").select(
        "family", "main", count(F.col("all") - F.col("most")).alias("rest_blocks"), count(F.col("most")).alias("main_blocks")
    )
    # Blocks of the largest part come after the others; these meet all, and those meet these.
    inside, hashed = F.col("part") == F.col("main"), F.xxhash64("node")
    block = F.when(inside, F.col("rest_blocks") + F.pmod(hashed, "main_blocks")).otherwise(F.pmod(hashed, "rest_blocks"))
    last = F.when(inside, F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("main_blocks")) - 1
    dealt = large.join(sizes, "family").select(
        "family", block.cast("int").alias("block"), F.sequence(F.lit(0), last.cast("int")).alias("others"), "node", "part"
    )
    made = F.arrow_udf(_wide_sketch, "n int, bits binary")("text")
    asked = stored(texts.join(dealt.select("node").distinct(), "node").select("node", made.alias("made")), "sketches")
    met = dealt.join(asked, "node").withColumn("other", F.explode("others")).select(
        "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "part",
        "made.n", "made.bits",
    )
    together = met.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
    return together.mapInArrow(_near_sketches, "x long, y long").distinct()


def _wide_sketch(texts: pa.Array) -> pa.Array:
    """Size and sketch of every set, of 4 to 8 bits a shingle."""
    own = [s for _, s in shingle_sets(texts)]
    sizes = pa.array([len(s) for s in own], pa.int32())
    bits = pa.array([sketch(s, max(64, 4 << (len(s) - 1).bit_length())) if len(s) else b"" for s in own], pa.binary())
    return pa.StructArray.from_arrays([sizes, bits], names=["n", "bits"])


def _near_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in _by_block(batches, 3):
        yield from _near(pa.Table.from_batches(held))


def _near(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of one block (i, i), or between the two of (i, j), that are in different parts and may link."""
    node, part, n, block = (rows.column(c).to_numpy() for c in ("node", "part", "n", "block"))
    alone = rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
    bits = [np.frombuffer(b, dtype=np.uint64) for b in rows.column("bits").to_pylist()]
    words = np.array([len(b) for b in bits])
    for width in np.unique(words).tolist():
        # Linked sets differ by a quarter in size at most, so their sketches are as wide or twice as wide.
        own = np.flatnonzero((words == width) | (words == 2 * width))
        narrow = np.stack([bits[i] if words[i] == width else bits[i][:width] ^ bits[i][width:] for i in own])
        for at in np.flatnonzero(words[own] == width).tolist():
            i = own[at]
            fits = (part[own] != part[i]) & (100 * n[own].astype(np.int64) >= 80 * n[i]) & (80 * n[own].astype(np.int64) <= 100 * n[i])
            # Each pair once: by place within a width, by the narrower one between two.
            fits &= (words[own] != width) | (np.arange(len(own)) > at)
            if not alone:
                fits &= block[own] != block[i]
            others = np.flatnonzero(fits)
            differ = np.bitwise_count(narrow[others] ^ narrow[at]).sum(axis=1, dtype=np.int64)
            found = own[others[differ <= may_differ(n[own[others]].astype(np.int64), np.int64(n[i]))]]
            if len(found):
                x, y = np.maximum(node[found], node[i]), np.minimum(node[found], node[i])
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in _by_block(batches, 2):
        yield _forest(held)


def _by_block(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each block, known by its first `width` columns. Blocks come in order; one at a time is held."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(width)])
        starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if len(batch) else []
        for a, b in zip(starts, [*starts[1:], len(batch)]):
            own = tuple(keys[:, a].tolist())
            if own != current and held:
                yield held
                held = []
            current = own
            held.append(batch.slice(a, b - a))
    if held:
        yield held


FREQUENT = 24  # shingles of more members are counted by a matrix product, others pair by pair
COLUMNS = 4096


def _overlaps(docs: np.ndarray, tokens: np.ndarray, size: int) -> np.ndarray:
    """Shared shingles of every two of `size` sets, given as (set, shingle) rows."""
    order = np.lexsort((docs, tokens))
    docs, tokens = docs[order], tokens[order]
    _, column, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    common = np.zeros((size, size), dtype=np.float32)
    often = np.flatnonzero(counts > FREQUENT)
    for at in range(0, len(often), COLUMNS):
        own = often[at : at + COLUMNS]
        place = np.full(len(counts), -1, dtype=np.int64)
        place[own] = np.arange(len(own))
        inside = place[column] >= 0
        matrix = np.zeros((size, len(own)), dtype=np.float32)
        matrix[docs[inside], place[column[inside]]] = 1
        common += matrix @ matrix.T
    starts = np.cumsum(counts) - counts
    for d in range(2, FREQUENT + 1):
        own = starts[counts == d]
        if len(own):
            sets_of = docs[own[:, None] + np.arange(d)]
            for a in range(d):
                for b in range(a + 1, d):
                    np.add.at(common, (sets_of[:, a], sets_of[:, b]), 1)
                    np.add.at(common, (sets_of[:, b], sets_of[:, a]), 1)
    return common


def _forest(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """For the members of one block: an edge from each to the first member of its connected part."""
    nodes = np.concatenate([b.column(2).to_numpy() for b in held])
    own = [s for b in held for _, s in shingle_sets(b.column(3))]
    size, n = len(nodes), np.array([len(s) for s in own], dtype=np.float64)
    docs = np.repeat(np.arange(size), n.astype(np.int64))
    common = _overlaps(docs, np.concatenate(own), size)
    linked = (common > 0) & (180.0 * common >= 80.0 * (n[:, None] + n[None, :]))
    label = np.arange(size)
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], size).min(axis=1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    x = np.flatnonzero(label != np.arange(size))
    return pa.RecordBatch.from_arrays([pa.array(nodes[x]), pa.array(nodes[label[x]])], names=["x", "y"])


_PAIR = "x long, y long, nx int, ny int, level int"


def _pairs(rows: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows["node"][x].view(np.int64)),
            pa.array(rows["node"][y].view(np.int64)),
            pa.array(rows["n"][x]),
            pa.array(rows["n"][y]),
            pa.array(rows["level"][x]),
        ],
        names=["x", "y", "nx", "ny", "level"],
    )


def _sorted_probes(table: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Rows by shingle, size and node, with the range of the shingle that each row belongs to."""
    rows = unpacked(table.column("cell"), _PROBE)
    order = np.lexsort((rows["node"], rows["n"], rows["token"]))
    rows = {name: column[order] for name, column in rows.items()}
    _, first, group, size = np.unique(rows["token"], return_index=True, return_inverse=True, return_counts=True)
    return rows, first[group] if len(first) else group, (first + size)[group] if len(first) else group


BLOCK = 1 << 19
SLACK = 2
LARGE = 64


def _ranges(start: np.ndarray, end: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every (of[i], j) with start[i] <= j < end[i], in blocks."""
    sizes = end - start
    keep = sizes > 0
    start, sizes, of = start[keep], sizes[keep], of[keep]
    sums = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = sums[at - 1] if at else 0
        to = max(int(np.searchsorted(sums, done + BLOCK, side="right")), at + 1)
        own = sizes[at:to]
        i = np.repeat(np.arange(at, to), own)
        j = start[i] + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        yield of[i], j
        at = to


def probe_pairs(cells: DataFrame) -> DataFrame:
    """One row per shared probe of two nodes that no family has compared or connected: x is the larger set, and probes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, low, high = _sorted_probes(pa.Table.from_batches(list(batches)))
        n = rows["n"].astype(np.int64)
        probes = np.flatnonzero(rows["use"])
        # The first row of the shingle that is large enough for x: sizes rise within a shingle.
        large = (high - low)[probes] > LARGE
        yield from _met(rows, n, _small_groups(n, low, probes[~large]))
        for a in np.unique(low[probes[large]]).tolist():
            b = int(high[a])
            own = probes[np.searchsorted(probes, a) : np.searchsorted(probes, b)]
            yield from _met(rows, n, _large_group(rows, n, a, b, own))

    return cells.groupBy("bucket").applyInArrow(_iterated(made), _PAIR)


def _iterated(function):
    """Spark tells the form that streams batches from the one with whole tables by these annotations."""

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)

    streamed.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return streamed


def _small_groups(n: np.ndarray, low: np.ndarray, probes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    return _ranges(low[probes], probes, probes)


def _large_group(rows, n, a: int, b: int, probes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one frequent shingle. Members of its largest family, or part if that is larger, meet only the others."""
    kind, main, most = "family", np.uint64(1), 0
    for name in ("family", "part"):
        values, counts = np.unique(rows[name][a:b][rows[name][a:b] != 0], return_counts=True)
        if len(counts) and counts.max() > most:
            kind, main, most = name, values[np.argmax(counts)], counts.max()
    others = a + np.flatnonzero(rows[kind][a:b] != main)
    inside = rows[kind][probes] == main
    # All smaller rows for those outside the family; the smaller ones outside for those inside.
    outer = probes[~inside]
    yield from _ranges(a + np.searchsorted(n[a:b], needed(n[outer])), outer, outer)
    inner = probes[inside]
    start = np.searchsorted(n[others], needed(n[inner]))
    for x, j in _ranges(start, np.searchsorted(others, inner), inner):
        yield x, others[j]


def _met(rows, n, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for x, y in pairs:
        fits = (100 * n[y] >= 80 * n[x]) & (rows["part"][x] != rows["part"][y]) & ~_same_family(rows, x, y)
        fits &= rows["pos"][y] < base_prefix(n[y]) + rows["level"][x] - 1
        # Sets of these two sizes share at least `least`; with SLACK more in either prefix they share SLACK + 1 probes.
        least = -(-4 * (n[x] + n[y]) // 9)
        slack = rows["level"][x] + SLACK + n[x] // 50
        fits &= (rows["pos"][x] < n[x] - least + slack) & (rows["pos"][y] < n[y] - least + slack)
        x, y = x[fits], y[fits]
        differ = sum((np.bitwise_count(rows[b][x] ^ rows[b][y]).astype(np.int64) for b in _SKETCH), np.zeros(len(x), np.int64))
        near = differ <= may_differ(n[x], n[y])
        yield _pairs(rows, x[near], y[near])


def _same_family(rows: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    same = np.zeros(len(x), dtype=bool)
    for one in _FAMILIES:
        for other in _FAMILIES:
            same |= (rows[one][x] == rows[other][y]) & (rows[one][x] != 0)
    return same


def candidates(probe_rows: DataFrame) -> DataFrame:
    """Pairs that share enough of the prefixes which `_met` compares.

    With prefixes of n - o + level + s, where o is the overlap that the pair needs, linked sets share level + s of them or
    all of a shorter prefix; at most level - 1 of those were left out as probes.
    """
    x, y, level = F.col("nx").cast("long"), F.col("ny").cast("long"), F.col("level").cast("long")
    least = F.ceil(F.expr("4 * (CAST(nx AS LONG) + ny) / 9"))
    spare = SLACK + F.floor(x / 50)
    # Prefixes that end earlier than that, as no longer ones are stored or probed.
    end = lambda n: F.least(n - F.ceil(n * 80 / 100) + level, n - least + level + spare, n)
    behind = F.greatest(x - end(x), y - end(y))
    counted = probe_rows.groupBy("x", "y", "nx", "ny", "level").agg(F.count(F.lit(1)).alias("probes"))
    return counted.where(F.col("probes") + level - 1 + behind >= least).select("x", "y")


def _linked(left: pa.Array, right: pa.Array) -> pa.Array:
    def both() -> Iterator[bool]:
        for (_, a), (_, b) in zip(shingle_sets(left), shingle_sets(right)):
            common = len(np.intersect1d(a, b, assume_unique=True))
            yield common > 0 and 100 * common >= 80 * (len(a) + len(b) - common)

    return pa.array(list(both()), pa.bool_())


def node_texts(wanted: DataFrame, nodes: DataFrame, df: DataFrame, key: str, text: str) -> DataFrame:
    """Stored rows (node, text) with one text of each wanted node."""
    wanted = stored(wanted.join(nodes, "node").select("node", "rep"), "wanted")
    docs = df.select(named(key).cast("long").alias("id"), named(text).alias("text"))
    near = with_mark(docs, "id", wanted, "rep").where("maybe").select("id", "text")
    texts = near.join(wanted, near["id"] == wanted["rep"]).select("node", "text")
    # An id may have several texts; the node's own is the one whose set it was made from.
    own = F.arrow_udf(_node_of, "long")("text") == F.col("node")
    return stored(texts.where(own).dropDuplicates(["node"]), "texts")


def verified(pairs: DataFrame, nodes: DataFrame, df: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs (x, y) that link, by the exact sets of one text of each node. Only texts in some pair are shuffled."""
    pairs = stored(pairs.distinct(), "pairs")
    wanted = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))).distinct()
    texts = node_texts(wanted, nodes, df, key, text)
    left = texts.select(F.col("node").alias("x"), F.col("text").alias("tx"))
    right = texts.select(F.col("node").alias("y"), F.col("text").alias("ty"))
    joined = pairs.join(left, "x").join(right, "y")
    return joined.where(F.arrow_udf(_linked, "boolean")("tx", "ty")).select("x", "y")


def _node_of(texts: pa.Array) -> pa.Array:
    return pa.array(
        [int(_node(own).view(np.int64)) if len(own) else None for _, own in shingle_sets(texts)], pa.int64()
    )


def edges(
    df: DataFrame, key: str = "doc_id", text: str = "text", dear: int = DEAR
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with n and node, nodes with rep, edges between nodes that connect what links)."""
    documents = stored(sets(df, key, text), "sets")
    known = documents.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    nodes = known.groupBy("node").agg(F.min("doc_id").alias("rep"), F.any_value("sketch").alias("sketch"))
    nodes = stored(nodes, "nodes")
    cells = stored(shared(postings(df.where(named(key).isNotNull()), text)), "shared")
    member_rows = sized(members(cells, dear))
    texts = node_texts(member_rows.select("node").distinct(), nodes, df, key, text)
    within = stored(family_links(member_rows, texts), "family-edges")
    parts = components(within, "x", "y")
    met = candidates(probe_pairs(chosen(cells, nodes, parts, dear))).unionByName(family_pairs(member_rows, texts, parts))
    crossing = verified(met, nodes, df, key, text)
    return documents, nodes, stored(within.unionByName(crossing).distinct(), "edges")


def grouped(df: DataFrame, key: str = "doc_id", text: str = "text", dear: int = DEAR) -> DataFrame:
    """Columns doc_id, n_shingles, component_id (smallest id reachable by links)."""
    documents, nodes, found = edges(df, key, text, dear)
    one = nodes.select(F.col("node").alias("x"), F.col("rep").alias("u"))
    other = nodes.select(F.col("node").alias("y"), F.col("rep").alias("v"))
    linked = found.join(one, "x").join(other, "y").select("u", "v")
    # One id with several sets: its sets belong together.
    reps = documents.join(nodes, "node").select("doc_id", "rep")
    several = reps.groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("last")).where("v < last")
    same = several.join(reps, "doc_id").where("rep <> v").select(F.col("rep").alias("u"), "v")
    parts = components(linked.unionByName(same))
    of = nodes.join(parts, nodes["rep"] == parts["node"], "left").select(
        nodes["node"].alias("of"), F.coalesce("component", "rep").alias("least")
    )
    joined = documents.join(of, documents["node"] == of["of"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def without_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of one document of each group, the one with the smallest id; same columns."""
    groups = grouped(df, key, text)
    gone = stored(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    rows = df.select(F.struct("*").alias("row"), named(key).cast("long").alias("id"))
    marked = with_mark(rows, "id", gone, "gone")
    sure = marked.where(~F.col("maybe")).select("row.*")
    asked = marked.where("maybe").join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")
    return sure.unionByName(asked) if len(set(df.columns)) == len(df.columns) else sure.union(asked)
