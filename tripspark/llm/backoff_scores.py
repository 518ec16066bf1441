"""Language-model scores with stupid backoff, from n-gram counts over the whole corpus.

A document is scored by the counts of all others. With c(g) the occurrences of an n-gram in all documents but this one,
and N their words:

    S(w | u v) = c(u v w) / c(u v)      if c(u v w) > 0, else 0.4 S(w | v)
    S(w | v)   = c(v w) / c(v)          if c(v w) > 0, else 0.4 S(w)
    S(w)       = c(w) / N               if c(w) > 0, else 0.4 / (N + 1)

The score is the mean natural logarithm over the document's words.

Relations, all keyed by 64-bit hashes and packed into cells:
1. Documents in chunks of `CHUNK_BYTES`, compressed (chunked.py).
2. `asked`: the distinct n-grams of a chunk with their counts, dealt by n-gram hash.
3. `_totals`: each hash bucket is one part of the count tables; it joins every n-gram asked for with its total.
4. `scored`: a chunk joins its documents' n-grams with the totals, takes each document's own occurrences off, and sums.

What is shuffled grows with the distinct n-grams of the chunks. A frequent n-gram has one row per chunk, not per
occurrence, so it makes no hot bucket; all buckets and chunks have a bounded size.

Cases: a null or empty text, or one without words, has 0 words and a null score. Repeated rows are documents of their own
and support each other. A corpus of one document has N = 0, so each word gets 0.4 / (0 + 1). An empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.chunked import (
    ASKED,
    Question,
    answered,
    asked_table,
    bucket_count_of,
    chunk_cells,
    chunk_count,
    documents,
    text_bytes,
)
from tripspark.llm.frames import named
from tripspark.llm.packed import bucket_of, rising
from tripspark.llm.text_blocks import Words, blocks, grams, word_counts, words_of

ORDER = 3
BACKOFF = 0.4
CHUNK_BYTES = 10 << 20
BUCKET_BYTES = 16 << 20  # of text, whose n-grams a bucket counts


def _all_words(texts: pa.ChunkedArray) -> Words:
    """The words of all texts of a chunk; found block by block, which keeps the work arrays small."""
    none = np.zeros(0, dtype=np.int64)
    parts = [(none, none.view(np.uint64), none)]
    for block in blocks(texts):
        own = words_of(block)
        parts.append((own.doc + block.first, own.hash, own.counts))
    doc, hashes, counts = (np.concatenate(c) for c in zip(*parts))
    return Words(doc, doc, doc, hashes, counts, np.cumsum(counts) - counts)


def _question(own: np.ndarray, n: int, buckets: int) -> Question:
    return Question(n, bucket_of(own, buckets))


def asked(chunks: DataFrame, buckets: int, order: int = ORDER) -> DataFrame:
    """The distinct n-grams of every chunk, rising within a bucket, with their counts."""

    def made(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        words = _all_words(documents(table.column("cell")).column("text"))
        rows = []
        for n in range(1, order + 1):
            own, counts = np.unique(grams(words, n)[0], return_counts=True)
            rows += _question(own, n, buckets).rows(chunk, [own, counts.astype(np.int64)], steps=(0,))
        return asked_table(rows)

    return chunks.groupBy("chunk").applyInArrow(made, ASKED)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where each row begins that differs from the one before."""
    begins = np.zeros(len(columns[0]), dtype=bool)
    begins[:1] = True
    for column in columns:
        begins[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(begins)


def _totals(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One part of the count tables: the sum over all chunks for every n-gram that was asked for."""
    order = rising(own)
    starts = _starts(own[order])
    totals = np.zeros(len(own), dtype=np.int64)
    if len(starts):
        totals[order] = np.repeat(np.add.reduceat(counts[order], starts), np.diff(starts, append=len(own)))
    return totals


_SCORED = "doc_id long, n_words long, n_full long, score double"


def _others(words: Words, n: int, totals: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """By the place of its first word: every n-gram's count in all other documents; `totals` knows those of rising n-grams.

    The n-grams are brought in order once. Equal ones stay in the order of their documents, so those of one document
    are neighbours too.
    """
    own, places = grams(words, n)
    order = rising(own)
    own, places = own[order], places[order]
    starts = _starts(own)
    known = np.repeat(totals(own[starts]), np.diff(starts, append=len(own)))
    mine = np.diff(_starts(own, words.doc[places]), append=len(own))
    others = np.zeros(len(words.doc) + 1, dtype=np.float64)
    others[places] = known - np.repeat(mine, mine)
    return others


def _scores(
    words: Words, totals: Callable[[int, np.ndarray], np.ndarray], order: int, corpus: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per document: n-grams found at the full order, and the sum of logarithms."""
    m = len(words.doc)
    rest = (corpus - words.counts).astype(np.float64)  # per document
    left = {n: _others(words, n, partial(totals, n)) for n in range(1, order + 1)}
    with np.errstate(divide="ignore", invalid="ignore"):
        known = np.log(left[1][:m]) - np.log(rest)[words.doc]
        value = np.where(left[1][:m] > 0, known, (np.log(BACKOFF) - np.log(rest + 1))[words.doc])
        full = np.zeros(m, dtype=bool)
        for n in range(2, order + 1):
            last = np.arange(n - 1, m)
            inside = words.doc[last] == words.doc[last - n + 1] if m >= n else np.zeros(0, dtype=bool)
            last = last[inside]
            count, context = left[n][last - n + 1], left[n - 1][last - n + 1]
            found = np.flatnonzero(count > 0)
            value[last] += np.log(BACKOFF)
            value[last[found]] = np.log(count[found]) - np.log(context[found])
            if n == order:
                full[last[found]] = True
    size = len(words.counts)
    return np.bincount(words.doc, weights=full, minlength=size), np.bincount(words.doc, weights=value, minlength=size)


def scored(df: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Columns doc_id, n_words, n_full (n-grams of the full order that other documents have too), score."""
    size = df.select(F.arrow_udf(_n_words, "long")(named(text)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    volume = text_bytes(df, text)
    buckets = bucket_count_of(df, volume, BUCKET_BYTES)
    chunks = chunk_cells(df, key, text, chunk_count(df, text, CHUNK_BYTES, volume))
    totals = answered(asked(chunks, buckets, order), ["u8", "i8"], _totals, steps=(0,))

    def made(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = documents(left.column("cell"))
        words = _all_words(docs.column("text"))

        def known(n: int, own: np.ndarray) -> np.ndarray:
            return _question(own, n, buckets).answers(right, "i8")

        full, total = _scores(words, known, order, size)
        counts = words.counts
        mean = np.where(counts > 0, total / np.maximum(counts, 1), np.nan)
        return pa.table(
            {
                "doc_id": docs.column("doc_id").cast(pa.int64()),
                "n_words": pa.array(counts, pa.int64()),
                "n_full": pa.array(full.astype(np.int64)),
                "score": pa.array(mean, pa.float64(), from_pandas=True),
            }
        )

    return chunks.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(made, _SCORED)


def _n_words(texts: pa.Array) -> pa.Array:
    return pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *(word_counts(b) for b in blocks(texts))]), pa.int64())
