"""Benchmark decontamination: a broadcast set of normalised test n-grams, scanned over the word windows of all texts.

Words are lower-cased; a window is `LENGTH` consecutive words of an item, or all its words if it has fewer. The hashes of
a text's windows are looked up in the set; a hit counts after its words are compared with the window's own. `marked` says
which words of a text are hit and by which items; `cleaned` removes the words or the documents.

The test windows are the only thing broadcast. A block of items holds at most `MAX_WINDOWS` of them (about 200 bytes
each); a larger benchmark is read in several blocks, each scanned over all texts, and the hits are united. Texts stay
where they lie: nothing is shuffled, so neither hot sources nor long texts meet in one task.

Cases: null and empty texts have no words and no hits; such items have no windows. Equal items each count. Repeated rows
get equal answers; an empty table gives no rows, an empty benchmark no hits. Other columns pass through `cleaned`. Item
ids are compared as strings; an item with a null id counts as the string "".
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.frames import named, stored
from tripspark.llm.text_blocks import SMALL_TABLE, Words, blocks, grams, lists, whole_grams, words_of

LENGTH = 10
MAX_WINDOWS = 500_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = "n_words long, runs array<struct<first:int,last:int,from:int,to:int>>, items array<string>"


def _plain(data: np.ndarray, start: int, end: int) -> bytes:
    """The words between two places, in lower case with one space between."""
    return b" ".join(_WORD.findall(data[start:end].tobytes().translate(SMALL_TABLE)))


def item_windows(texts: list[str], ids: list[str], length: int = LENGTH) -> dict[int, dict[int, list[tuple[bytes, str]]]]:
    """By number of words, then hash: the words and the item of every window."""
    found: dict[int, dict[int, list[tuple[bytes, str]]]] = {}
    for block in blocks(pa.array(texts, pa.large_string())):
        words = words_of(block)
        for hashes, places, short in ((*grams(words, length), False), (*whole_grams(words, length), True)):
            for h, p in zip(hashes.tolist(), places.tolist()):
                doc = int(words.doc[p])
                n = int(words.counts[doc]) if short else length
                entry = (_plain(block.data, words.start[p], words.end[p + n - 1]), ids[block.first + doc])
                row = found.setdefault(n, {}).setdefault(h, [])
                if entry not in row:
                    row.append(entry)
    return found


def _hits(words: Words, data: np.ndarray, n: int, windows: dict[int, list[tuple[bytes, str]]]):
    """(place of the first word, items) of all verified hits of windows of n words."""
    known = np.sort(np.fromiter(windows, dtype=np.uint64, count=len(windows)))
    hashes, places = grams(words, n)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    for i in np.flatnonzero(known[at] == hashes).tolist():
        p = int(places[i])
        own = _plain(data, words.start[p], words.end[p + n - 1])
        items = [item for text, item in windows[int(hashes[i])] if text == own]
        if items:
            yield p, items


def _marks(texts: pa.Array, windows: dict[int, dict[int, list[tuple[bytes, str]]]]) -> pa.StructArray:
    n_words, run_counts, item_counts = [], [], []
    runs: list[list[int]] = [[], [], [], []]
    items: list[str] = []
    for block in blocks(texts):
        words = words_of(block)
        delta = np.zeros(len(words.doc) + 1, dtype=np.int64)
        found: dict[int, set[str]] = {}
        for n, own in windows.items():
            for p, names in _hits(words, block.data, n, own):
                delta[p] += 1
                delta[p + n] -= 1
                found.setdefault(int(words.doc[p]), set()).update(names)
        hit = np.cumsum(delta[:-1]) > 0
        doc = words.doc
        new_doc = np.ones(len(doc), dtype=bool)
        new_doc[1:] = doc[1:] != doc[:-1]
        before = np.zeros(len(hit), dtype=bool)
        before[1:] = hit[:-1]
        first = np.flatnonzero(hit & (~before | new_doc))
        after = np.zeros(len(hit), dtype=bool)
        after[:-1] = hit[1:] & ~new_doc[1:]
        last = np.flatnonzero(hit & ~after)
        base, byte0 = words.firsts[doc[first]], block.offsets[doc[first]]
        for out, row in zip(runs, (first - base, last + 1 - base, words.start[first] - byte0, words.end[last] - byte0)):
            out.extend(row.tolist())
        run_counts.append(np.bincount(doc[first], minlength=len(block)))
        n_words.append(words.counts)
        for d in range(len(block)):
            own_items = sorted(found.get(d, ()))
            items.extend(own_items)
            item_counts.append(len(own_items))
    columns = pa.StructArray.from_arrays(
        [pa.array(r, pa.int32()) for r in runs], names=["first", "last", "from", "to"]
    )
    return pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
            lists(columns, np.concatenate(run_counts) if run_counts else np.zeros(0, dtype=np.int64)),
            lists(pa.array(items, pa.string()), np.array(item_counts, dtype=np.int64)),
        ],
        names=["n_words", "runs", "items"],
    )


def _united(marks: list[Column]) -> Column:
    """Hits of several blocks of items as one: runs that touch or overlap become one run."""
    if len(marks) == 1:
        return marks[0]
    runs = F.array_sort(F.flatten(F.array(*[m["runs"] for m in marks])))
    none = F.slice(runs, 1, 0)
    grown = F.aggregate(
        runs,
        none,
        lambda a, r: F.when(
            (F.size(a) > 0) & (r["first"] <= F.get(a, F.size(a) - 1)["last"]),
            F.array_append(
                F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))),
                F.struct(
                    F.get(a, F.size(a) - 1)["first"].alias("first"),
                    F.greatest(F.get(a, F.size(a) - 1)["last"], r["last"]).alias("last"),
                    F.get(a, F.size(a) - 1)["from"].alias("from"),
                    F.greatest(F.get(a, F.size(a) - 1)["to"], r["to"]).alias("to"),
                ),
            ),
        ).otherwise(F.array_append(a, r)),
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[m["items"] for m in marks]))))
    return F.struct(marks[0]["n_words"].alias("n_words"), grown.alias("runs"), items.alias("items"))


def marked(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    into: str = "mark",
    length: int = LENGTH,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """All columns of `df` and the struct `into`: n_words, runs of hit words (word places and bytes), items.

    A column named `into` is replaced. Above `max_windows` the items are dealt into blocks, which are searched one after
    the other over stored rows: driver and workers hold one block at a time.
    """
    spark = df.sparkSession
    tests = benchmark.select(
        F.coalesce(named(item).cast("string"), F.lit("")).alias("id"), F.coalesce(named(item_text), F.lit("")).alias("x")
    )
    # A text has no more windows than half its characters.
    size = tests.agg(F.coalesce(F.sum(F.length("x")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-(size // 2) // max_windows))
    made = df.select(F.struct("*").alias("row"), named(text).alias("x"))
    for part in range(parts):
        own = tests.where(F.pmod(F.xxhash64("id", "x"), F.lit(parts)) == part).collect()
        sent = spark.sparkContext.broadcast(item_windows([r["x"] for r in own], [r["id"] for r in own], length))
        made = made.withColumn("new", _marker(sent)(F.col("x")))
        made = made.select("row", "x", (_united([F.col("mark"), F.col("new")]) if part else F.col("new")).alias("mark"))
        if parts > 1:
            made = stored(made, "marked")
            sent.destroy()
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c != into]
    return made.select(*kept, F.col("mark").alias(into))


def _marker(sent):
    @F.arrow_udf(_MARK)
    def mark(texts: pa.Array) -> pa.Array:
        return _marks(texts, sent.value)

    return mark


def hit_words(mark: Column) -> Column:
    return F.aggregate(mark["runs"], F.lit(0), lambda a, r: a + r["last"] - r["first"]).cast("long")


def cleaned(df: DataFrame, benchmark: DataFrame, text: str = "text", drop_documents: bool = False, **options) -> DataFrame:
    """The columns of `df`, without the documents that are hit, or with the hit words cut out of their texts."""
    row = df.select(F.struct("*").alias("row"), named(text).alias("x"))
    found = marked(row, benchmark, text="x", into="mark", **options)
    if drop_documents:
        return found.where(F.size("mark.runs") == 0).select("row.*")
    runs, raw = F.col("mark.runs"), F.encode("x", "UTF-8")
    start = lambda i: F.coalesce(F.get(runs, i - 1)["to"], F.lit(0))
    pieces = F.transform(runs, lambda r, i: F.decode(F.substr(raw, start(i) + 1, r["from"] - start(i)), "UTF-8"))
    tail = F.decode(F.substr(raw, start(F.size(runs)) + 1), "UTF-8")
    clean = F.when(F.size(runs) > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(F.col("x"))
    return found.select(F.col("row").withField("`" + text + "`", clean).alias("row")).select("row.*")
