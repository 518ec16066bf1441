"""Words and n-grams of many texts at once, as arrays over the bytes of an Arrow column.

Both word definitions of this package can be told from single bytes of UTF-8: every byte of a character beyond ASCII is
128 or more, and those characters belong to words. So one table lookup per byte finds all words of a block of texts, and
prefix sums give a 64-bit hash of each. Blocks are bounded in bytes; only a single longer text makes a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BYTES = np.arange(256)
_DIGITS = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LOWER = (_BYTES >= 0x61) & (_BYTES <= 0x7A)
LETTERS = _DIGITS | _UPPER | _LOWER | (_BYTES >= 0x80)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F] with A-Z, which gets lower case
NO_BLANKS = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))  # [^\x20\x09-\x0D]
SMALL = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)  # A-Z to a-z
SMALL_TABLE = SMALL.tobytes()

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _length_term(n: int) -> np.uint64:
    return np.uint64(n * int(_STEP) % (1 << 64))



def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_VALUES = mixed((_BYTES.astype(np.uint64) + np.uint64(1)) * _ODD)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) <= n:  # also for blocks without any byte
        size = max(n + 1, 2 * BLOCK_BYTES)
        for name, base in (("up", _ODD), ("down", _ODD_INVERSE)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"], _POWERS["down"]


@dataclass
class Block:
    """Consecutive texts of a column: their bytes, and where each begins (one place more at the end)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Of all words of a block: the number of the text, first byte, byte after the last, and hash."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    counts: np.ndarray  # words per text
    firsts: np.ndarray  # place of the first word of each text


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1]
        yield Block(first, data[own[0] : own[-1]], own - own[0])
        first = last


def words_of(block: Block, kind: np.ndarray = LETTERS) -> Words:
    data, offsets, n = block.data, block.offsets, len(block.data)
    inside = kind[data]
    opens = np.zeros(n + 1, dtype=bool)
    opens[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | opens[:n]))
    end = np.flatnonzero(inside & (~after | opens[1:])) + 1
    up, down = _powers(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUES[SMALL[data]] * up[:n], out=sums[1:])
    value = (sums[end] - sums[start]) * down[start]
    hashes = mixed(value + (end - start).astype(np.uint64) * _STEP)
    doc = np.searchsorted(offsets, start, side="right") - 1
    counts = np.bincount(doc, minlength=len(block)).astype(np.int64)
    firsts = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.zeros(0, dtype=np.int64)
    return Words(doc, start, end, hashes, counts, firsts)


def word_counts(block: Block, kind: np.ndarray = LETTERS) -> np.ndarray:
    """Words per text, without their hashes."""
    n = len(block.data)
    inside = kind[block.data]
    opens = np.zeros(n + 1, dtype=bool)
    opens[block.offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    sums = np.concatenate(([0], np.cumsum(inside & (~before | opens[:n]))))
    return sums[block.offsets[1:]] - sums[block.offsets[:-1]]


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words of one text, and the place of each one's first word."""
    h, m = words.hash, len(words.hash) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = np.full(m, _length_term(n), dtype=np.uint64)
    for j in range(n):
        total = total * _ODD + h[j : m + j]
    place = np.flatnonzero(words.doc[:m] == words.doc[n - 1 :])
    return mixed(total[place]), place


def whole_grams(words: Words, below: int) -> tuple[np.ndarray, np.ndarray]:
    """For texts with 1 to below - 1 words: the hash of all their words, and the place of the first."""
    hashes, places = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for n in range(1, below):
        first = words.firsts[words.counts == n]
        if len(first):
            total = np.full(len(first), _length_term(n), dtype=np.uint64)
            for j in range(n):
                total = total * _ODD + words.hash[first + j]
            hashes.append(mixed(total))
            places.append(first)
    return np.concatenate(hashes), np.concatenate(places)


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """One list per text from the values of all texts in order."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), values)
