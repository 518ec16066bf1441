"""Exact removal of repeated 50-byte strings, by prefix-free parsing of the corpus.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller id. Strings never cross documents.

Parsing. A rolling hash runs over the `TRIGGER`-byte strings of a text. The one with the least hash among the
50 - TRIGGER + 1 that a 50-byte string has is that string's trigger; where the triggers change, a phrase ends. So equal
50-byte strings have equal triggers at equal places, and every string starts in one phrase. A phrase is written with what
its strings reach beyond it: the dictionary holds the distinct phrases, the parse is their sequence in the texts. Equal
text has equal phrases, so highly repetitive text has a small dictionary.

Corpus order. The suffixes of the dictionary, cut at 50 bytes and compared by 64-bit hashes, put equal strings of all
texts side by side. Only phrases whose trigger occurs elsewhere can hold a repeated string, and only one occurrence of a
phrase, the one in the smallest document, has to be sorted: all others repeat it as a whole. The sort is dealt by trigger:
equal strings have equal triggers, so each bucket of triggers is a range of the order of its own.

Rounds, as questions from chunks of documents to buckets of triggers (chunked.py):
1. Which triggers occur more than once? (32 bits of hash in a bucket; a rare false yes only costs work.)
2. Of those phrases: does a smaller document have the same phrase? If so, all its strings go. Does the trigger have other
   phrases besides? Then the strings of the first occurrence have to be compared.
3. Of those strings: does a smaller document have the same string?
4. The answers become spans of bytes.

A trigger, a phrase or a string that a third of all documents share has one packed entry per occurrence in one bucket and
is compared by sorting; nothing is compared pairwise. Texts longer than `PIECE` bytes are parsed in overlapping pieces.

Cases: a null text is empty; texts below 50 bytes have nothing to lose. Rows with equal ids are one document: they don't
repeat each other. A null id is larger than every other. An empty table gives no rows. Other columns are not read by
`spans`, and pass through `cleaned`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.chunked import (
    ASKED,
    Question,
    answered,
    asked_table,
    chunk_cells,
    chunk_count,
    documents,
    note,
    note_of,
)
from tripspark.llm.frames import named, whole_text
from tripspark.llm.packed import bucket_count, bucket_of
from tripspark.llm.text_blocks import mixed

LENGTH = 50
TRIGGER = 24
PIECE = 1 << 19
CHUNK_BYTES = 8 << 20
LAST = np.iinfo(np.int64).max  # stands for a null id

_PLACE_BITS = np.uint64(20)  # of a place within a piece
_PLACES = np.uint64((1 << 20) - 1)
_ODD = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    row = np.full(PIECE + 1, base, dtype=np.uint64)
    row[0] = 1
    return np.multiply.accumulate(row)


_UP, _DOWN = _powers(_ODD), _powers(pow(_ODD, -1, 1 << 64))
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_KEEP, _WHOLE, _COMPARE = 0, 1, 2


@dataclass
class Piece:
    """Some texts, or a part of a long one: rows of the chunk, and where each begins in the bytes of the chunk."""

    start: int  # in the chunk's bytes
    data: np.ndarray
    ends: np.ndarray  # for every byte: end of its text within the piece
    sums: np.ndarray
    doc: np.ndarray  # row of the chunk, for every byte


@dataclass
class Phrases:
    """Phrases of a piece: trigger, first and last start of a string (within the piece)."""

    trigger: np.ndarray
    first: np.ndarray
    last: np.ndarray


def pieces(offsets: np.ndarray, data: np.ndarray, size: int = PIECE) -> Iterator[Piece]:
    """Whole texts up to `size` bytes together; longer texts cut so that every 50-byte string is in one piece."""
    row, n = 0, len(offsets) - 1
    while row < n:
        last = min(max(int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1, row + 1), n)
        start, end = int(offsets[row]), int(offsets[last])
        step = size - LENGTH + 1
        for at in range(start, max(end, start + 1), step) if end - start > size else [start]:
            to = min(at + size, end)
            if to - at >= LENGTH:
                inner = np.clip(offsets[row : last + 1], at, to) - at
                doc = np.repeat(np.arange(row, last), np.diff(inner))
                sums = np.zeros(to - at + 1, dtype=np.uint64)
                np.cumsum(_BYTE[data[at:to]] * _UP[: to - at], out=sums[1:])
                yield Piece(at, data[at:to], inner[1:][doc - row], sums, doc)
        row = last


def _hashes(piece: Piece, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (piece.sums[end] - piece.sums[start]) * _DOWN[start]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    have = 1
    while have < width:
        more = min(have, width - have)
        values = np.minimum(values[:-more], values[more:])
        have += more
    return values


def parsed(piece: Piece) -> Phrases:
    n = len(piece.data)
    place = np.arange(n - TRIGGER + 1)
    rolling = mixed(_hashes(piece, place, place + TRIGGER))
    ranked = (rolling >> _PLACE_BITS << _PLACE_BITS) | place.astype(np.uint64)
    least = _least(ranked, LENGTH - TRIGGER + 1)
    string = np.flatnonzero(np.arange(n - LENGTH + 1) + LENGTH <= piece.ends[: n - LENGTH + 1])
    owner = (least[string] & _PLACES).astype(np.int64)
    opens = np.ones(len(string), dtype=bool)
    opens[1:] = (owner[1:] != owner[:-1]) | (string[1:] != string[:-1] + 1)
    at = np.flatnonzero(opens)
    closes = np.append(at[1:], len(string)) - 1
    return Phrases(owner[at], string[at], string[closes]) if len(string) else Phrases(owner, string, string)


@dataclass
class Parse:
    """All phrases of a chunk."""

    docs: pa.Table
    ids: np.ndarray
    offsets: np.ndarray
    data: np.ndarray
    key: np.ndarray  # of the trigger, evenly spread
    phrase: np.ndarray  # hash of the phrase with what its strings reach beyond it
    doc: np.ndarray
    first: np.ndarray  # in the chunk's bytes
    last: np.ndarray
    piece: np.ndarray  # start of the piece that the phrase was found in
    size: int  # of pieces

    def strings(self, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(phrase, start, hash) of all strings of the chosen phrases."""
        for piece in pieces(self.offsets, self.data, self.size):
            own = chosen[self.piece[chosen] == piece.start]
            sizes = self.last[own] - self.first[own] + 1
            phrase = np.repeat(own, sizes)
            start = np.repeat(self.first[own] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            inner = start - piece.start
            yield phrase, start, mixed(_hashes(piece, inner, inner + LENGTH))


def parse(cells: pa.ChunkedArray, size: int = PIECE) -> Parse:
    docs = documents(cells)
    text = docs.column("text").combine_chunks().fill_null("")
    text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
    _, places, values = text.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(values, dtype=np.uint8)[offsets[0] : offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    ids = docs.column("doc_id").fill_null(LAST).to_numpy().astype(np.int64)
    none = np.zeros(0, dtype=np.int64)
    parts = [(none.view(np.uint64), none.view(np.uint64), none, none, none, none)]
    for piece in pieces(offsets, data, size):
        own = parsed(piece)
        key = mixed(_hashes(piece, own.trigger, own.trigger + TRIGGER) ^ np.uint64(_ODD))
        shape = ((own.trigger - own.first) * 64 + own.last - own.first).astype(np.uint64)
        phrase = mixed(_hashes(piece, own.first, own.last + LENGTH) + mixed(shape))
        doc = piece.doc[own.first]
        parts.append((key, phrase, doc, own.first + piece.start, own.last + piece.start, np.full(len(doc), piece.start)))
    key, phrase, doc, first, last, start = (np.concatenate(c) for c in zip(*parts))
    return Parse(docs, ids, offsets, data, key, phrase, doc, first, last, start, size)


def _low(key: np.ndarray) -> np.ndarray:
    return (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _again(trigger: np.ndarray) -> np.ndarray:
    """Answer 1: does the trigger occur more than once?"""
    _, place, counts = np.unique(trigger, return_inverse=True, return_counts=True)
    return (counts[place] > 1).astype(np.uint8)


def _least_id(place: np.ndarray, ids: np.ndarray) -> np.ndarray:
    least = np.full(int(place.max(initial=-1)) + 1, LAST, dtype=np.int64)
    np.minimum.at(least, place, ids)
    return least[place]


def _state(trigger: np.ndarray, phrase: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Answer 2: is the phrase a repetition, or one whose strings have to be compared?"""
    _, phrases = np.unique(phrase, return_inverse=True)
    first = _least_id(phrases, ids)
    distinct = np.unique(np.stack([trigger.astype(np.uint64), phrases.astype(np.uint64)]), axis=1)[0]
    names, kinds = np.unique(distinct, return_counts=True)
    several = kinds[np.searchsorted(names, trigger.astype(np.uint64))] > 1
    return np.where(ids > first, _WHOLE, np.where(several, _COMPARE, _KEEP)).astype(np.uint8)


def _repeats(string: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Answer 3: does a smaller document have the string?"""
    _, place = np.unique(string, return_inverse=True)
    return (ids > _least_id(place, ids)).astype(np.uint8)


def _compared(own: Parse, state: np.ndarray, buckets: int) -> tuple[Question, np.ndarray, np.ndarray, np.ndarray]:
    none = np.zeros(0, dtype=np.int64)
    parts = [(none, none, none.view(np.uint64)), *own.strings(np.flatnonzero(state == _COMPARE))]
    phrase, start, string = (np.concatenate(c) for c in zip(*parts))
    return Question(3, bucket_of(own.key[phrase], buckets)), phrase, start, string


_SPANS = (
    "doc_id long, text_hash binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<from:int,to:int>>"
)


def spans(df: DataFrame, key: str = "doc_id", text: str = "text", piece: int = PIECE) -> DataFrame:
    """Per row: doc_id, the text's sha256, bytes, removed bytes, the removed runs (from, to), sha256 of what is kept."""
    buckets = bucket_count(df.sparkSession)
    chunks = chunk_cells(df, key, text, chunk_count(df, text, CHUNK_BYTES))

    def first(table: pa.Table) -> pa.Table:
        own, chunk = parse(table.column("cell"), piece), table.column("chunk")[0].as_py()
        return asked_table(Question(1, bucket_of(own.key, buckets)).rows(chunk, [_low(own.key)]))

    def second(left: pa.Table, right: pa.Table) -> pa.Table:
        own, chunk = parse(left.column("cell"), piece), left.column("chunk")[0].as_py()
        again = Question(1, bucket_of(own.key, buckets)).answers(right, "u1")
        at = np.flatnonzero(again)
        question = Question(2, bucket_of(own.key[at], buckets))
        rows = question.rows(chunk, [_low(own.key[at]), own.phrase[at], own.ids[own.doc[at]]], steps=(2,))
        return asked_table([*rows, note(chunk, buckets, again)])

    def state_of(own: Parse, answers: pa.Table) -> np.ndarray:
        at = np.flatnonzero(note_of(answers, "u1"))
        state = np.zeros(len(own.key), dtype=np.uint8)
        state[at] = Question(2, bucket_of(own.key[at], buckets)).answers(answers, "u1")
        return state

    def third(left: pa.Table, right: pa.Table) -> pa.Table:
        own, chunk = parse(left.column("cell"), piece), left.column("chunk")[0].as_py()
        state = state_of(own, right)
        question, phrase, _, string = _compared(own, state, buckets)
        rows = question.rows(chunk, [string, own.ids[own.doc[phrase]]], steps=(1,))
        return asked_table([*rows, note(chunk, buckets, state)])

    def last(left: pa.Table, right: pa.Table) -> pa.Table:
        own = parse(left.column("cell"), piece)
        state = note_of(right, "u1") if len(right) else np.zeros(len(own.key), dtype=np.uint8)
        question, _, start, _ = _compared(own, state, buckets)
        gone = question.answers(right, "u1").astype(bool)
        return _cut(own, state, start[gone])

    by_chunk = lambda df: df.groupBy("chunk")
    again = answered(by_chunk(chunks).applyInArrow(first, ASKED), ["u4"], _again)
    state = answered(
        by_chunk(chunks).cogroup(by_chunk(again)).applyInArrow(second, ASKED), ["u4", "u8", "i8"], _state, steps=(2,)
    )
    gone = answered(by_chunk(chunks).cogroup(by_chunk(state)).applyInArrow(third, ASKED), ["u8", "i8"], _repeats, steps=(1,))
    return by_chunk(chunks).cogroup(by_chunk(gone)).applyInArrow(last, _SPANS)


def _cut(own: Parse, state: np.ndarray, starts: np.ndarray) -> pa.Table:
    """Every removed string covers its 50 bytes; runs of covered bytes are the spans."""
    whole = np.flatnonzero(state == _WHOLE)
    delta = np.zeros(len(own.data) + 1, dtype=np.int64)
    np.add.at(delta, own.first[whole], 1)
    np.add.at(delta, own.last[whole] + LENGTH, -1)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + LENGTH, -1)
    covered = np.cumsum(delta[:-1]) > 0
    rows: dict[str, list] = {name: [] for name in ("text_hash", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")}
    for a, b in zip(own.offsets[:-1].tolist(), own.offsets[1:].tolist()):
        bytes_, gone = own.data[a:b], covered[a:b]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
        runs = edges.reshape(-1, 2)
        rows["text_hash"].append(hashlib.sha256(bytes_.tobytes()).digest())
        rows["n_bytes"].append(b - a)
        rows["n_removed"].append(int(gone.sum()))
        rows["n_spans"].append(len(runs))
        rows["kept_sha256"].append(hashlib.sha256(bytes_[~gone].tobytes()).hexdigest())
        rows["spans"].append([{"from": f, "to": t} for f, t in runs.tolist()])
    kinds = {
        "text_hash": pa.binary(),
        "n_bytes": pa.int64(),
        "n_removed": pa.int64(),
        "n_spans": pa.int64(),
        "kept_sha256": pa.string(),
        "spans": pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])),
    }
    found = {"doc_id": own.docs.column("doc_id").cast(pa.int64())}
    return pa.table(found | {name: pa.array(rows[name], kind) for name, kind in kinds.items()})


def cleaned(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same rows and columns without the removed bytes; bytes that are no longer UTF-8 at a cut become U+FFFD."""
    found = spans(df, key, text).where("n_removed > 0").select("doc_id", "text_hash", "spans").dropDuplicates(["doc_id", "text_hash"])
    rows = df.select(
        F.struct("*").alias("row"),
        named(key).cast("long").alias("id"),
        F.unhex(F.sha2(whole_text(text), 256)).alias("hash"),
        F.encode(whole_text(text), "UTF-8").alias("raw"),
    )
    joined = rows.join(found, rows["id"].eqNullSafe(found["doc_id"]) & (rows["hash"] == found["text_hash"]), "left")
    runs = F.col("spans")
    start = lambda i: F.coalesce(F.get(runs, i - 1)["to"], F.lit(0))
    pieces_ = F.transform(runs, lambda r, i: F.substr("raw", start(i) + 1, r["from"] - start(i)))
    empty = F.lit(b"")
    kept = F.concat(F.aggregate(pieces_, empty, lambda a, p: F.concat(a, p)), F.substr("raw", start(F.size(runs)) + 1))
    decoded = F.try_validate_utf8(kept.cast("string"))
    clean = F.when(runs.isNull(), F.col("row")[text]).otherwise(F.coalesce(decoded, F.make_valid_utf8(kept.cast("string"))))
    return joined.select(F.col("row").withField("`" + text + "`", clean).alias("row")).select("row.*")
