"""Runs of repeated words in a text, found by recompression.

A run is a stretch of words with a smallest period q (words q apart are identical), at least `LEAST` words and two periods
long, that no neighbouring word extends.

Grammar. The words of a block of texts, each text closed by a mark that occurs once, are rewritten until few symbols are
left: first every stretch of one symbol becomes one symbol (block compression), then every pair of a left and a right
symbol (pair compression, sides by a hash of the symbol). Equal words give equal symbols wherever they stand, except at the
ends, so the levels answer how far two places agree (the longest common extension): a query climbs while both places stand
at the start of equal symbols and comes down where they differ, a bounded number of symbols a level. Read backwards, the
same levels give the extension to the left.

Candidates. A run of period p holds a stretch of at least w = max(`LEAST`, 2p) - p words that equal the word p later, and
so a whole cell of the grid of step (w + 1) // 2. All cells of all periods are n log n (the harmonic sum); few are left once
their first words are compared. Of neighbouring cells only the first is asked, the next one behind its extension after
that, so a long run is asked about once per multiple of its period. The extensions are exact; of equal stretches the
smallest period stays.

A text is handled by one task, in memory that grows with its words (some 200 bytes each); short texts share a block.

Cases: a null or empty text has no words and no runs. Rows are independent: repeated rows and ids, also null ones, give a
row each. An empty table gives no rows. Other columns pass through `with_runs`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from tripspark.llm.frames import named

LEAST = 12
BLOCK_WORDS = 150_000
CELLS = 1 << 20  # grid cells looked at together
PROBE = 6  # words of a cell that are compared before the grammar is asked
TOP = 8  # symbols at which rewriting stops

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@dataclass
class Level:
    """Symbols of a level, the symbol above each, and for each symbol above its first one here (one more at the end)."""

    symbols: np.ndarray
    up: np.ndarray | None = None
    first: np.ndarray | None = None
    blocks: bool = False

    def mirrored(self) -> Level:
        if self.up is None:
            return Level(self.symbols[::-1].copy())
        above = len(self.first) - 2
        return Level(
            self.symbols[::-1].copy(), (above - self.up)[::-1].copy(), (len(self.symbols) - self.first)[::-1].copy(), self.blocks
        )


def _side(symbols: np.ndarray, level: int) -> np.ndarray:
    """Left or right, anew on each level."""
    mixed = (symbols.astype(np.uint64) + np.uint64(7919 * level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63) == 0


def _renamed(one: np.ndarray, other: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """Equal names from `free` on for equal pairs."""
    spread = int(other.max()) + 1 if len(other) else 1
    found, place = np.unique(one * spread + other, return_inverse=True)
    return free + place, free + len(found)


def grammar(words: np.ndarray) -> list[Level]:
    """The levels of a sequence of numbers, from the words up."""
    levels = [Level(words.astype(np.int64))]
    free = int(words.max()) + 1 if len(words) else 0
    turn = 0
    while len(levels[-1].symbols) > TOP:
        own = levels[-1].symbols
        heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        if len(heads) < len(own):
            free = _grown(levels, heads, free, blocks=True)
            continue
        turn += 1
        left = _side(own, turn)
        paired = np.concatenate(([False], left[:-1] & ~left[1:]))
        if paired.any():
            free = _grown(levels, np.flatnonzero(~paired), free, blocks=False)
    return levels


def _grown(levels: list[Level], heads: np.ndarray, free: int, blocks: bool) -> int:
    low = levels[-1]
    first = np.append(heads, len(low.symbols))
    sizes = np.diff(first)
    low.up = np.repeat(np.arange(len(heads)), sizes)
    low.first, low.blocks = first, blocks
    above = low.symbols[heads].copy()
    joined = np.flatnonzero(sizes > 1)
    last = sizes[joined] if blocks else low.symbols[heads[joined] + 1]
    above[joined], free = _renamed(above[joined], last, free)
    levels.append(Level(above))
    return free


def extensions(levels: list[Level], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many symbols agree from the places `one` and `other` on. They differ, and the last symbol occurs once."""
    p, q = one.copy(), other.copy()
    stop = np.full(len(p), len(levels) - 1)
    climbing = np.arange(len(p))
    for at, level in enumerate(levels):
        a, b = p[climbing], q[climbing]
        same = level.symbols[a] == level.symbols[b]
        stop[climbing[~same]] = at
        climbing, a, b = climbing[same], a[same], b[same]
        if level.up is None or not len(climbing):
            break
        up, first = level.up, level.first
        inside = (first[up[a]] != a) | (first[up[b]] != b)
        if level.blocks:
            rest_a, rest_b = first[up[a] + 1] - a, first[up[b] + 1] - b
            step = np.where(inside, np.minimum(rest_a, rest_b), 0)
            done = inside & (rest_a != rest_b)
        else:
            step, done = inside.astype(np.int64), np.zeros(len(a), dtype=bool)
        a, b = a + step, b + step
        p[climbing], q[climbing] = a, b
        stop[climbing[done]] = at
        climbing, a, b = climbing[~done], a[~done], b[~done]
        p[climbing], q[climbing] = up[a], up[b]
    order = np.argsort(-stop, kind="stable")
    joined = np.searchsorted(-stop[order], -np.arange(len(levels)), side="right")
    for at in range(len(levels) - 1, -1, -1):
        level, own = levels[at], order[: joined[at]]
        if not len(own):
            continue
        a, b = p[own], q[own]
        going = np.flatnonzero(level.symbols[a] == level.symbols[b])
        while len(going):
            x, y = a[going], b[going]
            if level.blocks:
                step = np.minimum(level.first[level.up[x] + 1] - x, level.first[level.up[y] + 1] - y)
            else:
                step = 1
            a[going], b[going] = x + step, y + step
            going = going[level.symbols[a[going]] == level.symbols[b[going]]]
        if at:
            a, b = levels[at - 1].first[a], levels[at - 1].first[b]
        p[own], q[own] = a, b
    return p - one


def _cells(sizes: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Text, period, step and number of cells for every period of every text, in portions."""
    doc = np.flatnonzero(sizes >= least)
    while len(doc):
        upto = max(1, int(np.searchsorted(np.cumsum(sizes[doc] // 2), CELLS // 8, side="right")))
        now, doc = doc[:upto], doc[upto:]
        half = sizes[now] // 2
        own = np.repeat(now, half)
        period = np.arange(half.sum()) - np.repeat(np.cumsum(half) - half, half) + 1
        stretch = np.maximum(least, 2 * period) - period
        fits = period + stretch <= sizes[own]
        own, period, step = own[fits], period[fits], (stretch[fits] + 1) // 2
        count = (sizes[own] - period) // step
        first, ends = 0, np.cumsum(count)
        while first < len(count):
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + CELLS, side="right")))
            yield own[first:last], period[first:last], step[first:last], count[first:last]
            first = last


def found_runs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    `words` holds texts with a number of its own before the first and behind each; `starts` and `sizes` say where they are.
    """
    levels = grammar(words)
    back = [level.mirrored() for level in levels]
    n = len(words)
    padded = np.concatenate((words, np.full(PROBE, -1)))
    found = [np.zeros((0, 3), dtype=np.int64)]
    for doc, period, step, count in _cells(sizes, least):
        row = np.repeat(np.arange(len(count)), count)
        cell = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        i, p, g = starts[doc][row] + cell * step[row], period[row], step[row]
        for j in range(PROBE):
            alike = (j >= g) | (padded[i + j] == padded[np.minimum(i + j + p, n)])
            i, p, g, row = i[alike], p[alike], g[alike], row[alike]
        if not len(i):
            continue
        # Neighbouring cells that are left make a chain; each chain is asked from cell to cell.
        opens = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (i[1:] - i[:-1] != g[1:]))))
        at, ends = opens, np.append(opens[1:], len(i))
        while len(at):
            x, y = i[at], i[at] + p[at]
            right = extensions(levels, x, y)
            left = extensions(back, n - x, n - y)  # of the places before
            whole = left + right + p[at]
            long = whole >= np.maximum(least, 2 * p[at])
            found.append(np.column_stack((x - left, whole, p[at]))[long])
            at = at + np.maximum(1, -(-right // g[at]))
            going = at < ends
            at, ends = at[going], ends[going]
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), dtype=bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)  # a multiple of the period gives the same stretch
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that stay when each run keeps its first period, joined by blanks."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def _answers(texts: list[list[bytes]], least: int) -> list[tuple[np.ndarray, bytes]]:
    names: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes
    words = np.full(int(sizes.sum()) + len(texts) + 1, -1, dtype=np.int64)
    for text, start in zip(texts, starts.tolist()):
        words[start : start + len(text)] = [names.setdefault(w, len(names)) for w in text]
    marks = np.flatnonzero(words < 0)
    words[marks] = len(names) + np.arange(len(marks))
    runs = found_runs(words, starts, sizes, least)
    edges = np.searchsorted(runs[:, 0], np.append(starts, len(words)))
    answers = []
    for text, start, a, b in zip(texts, starts.tolist(), edges[:-1], edges[1:]):
        own = runs[a:b] - np.array([start, 0, 0])
        answers.append((own, collapsed(text, own)))
    return answers


def with_runs(docs: DataFrame, text: str = "text", into: str = "runs", rest: str = "collapsed", least: int = LEAST) -> DataFrame:
    """`docs` with the runs of each text, by start and period, and the text collapsed.

    Columns named `into` and `rest` are replaced. Words are numbered from 0.
    """
    kept = [f for f in docs.schema.fields if f.name not in (into, rest)]
    schema = StructType([*kept, *StructType.fromDDL(f"r {RUNS}").fields, StructField("t", StringType())])
    schema.fields[-2].name, schema.fields[-1].name = into, rest
    schema = StructType(schema.fields)
    place = [f.name for f in kept].index(text)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(place).cast(pa.large_binary())
            first = 0
            while first < len(batch):
                texts, count = [], 0
                while first + len(texts) < len(batch) and (count < BLOCK_WORDS):
                    texts.append((own[first + len(texts)].as_py() or b"").split())
                    count += len(texts[-1]) + 1
                answers = _answers(texts, least)
                offsets = np.concatenate(([0], np.cumsum([len(r) for r, _ in answers])))
                runs = np.concatenate([r for r, _ in answers])
                names = ("start", "length", "period")
                items = pa.StructArray.from_arrays([pa.array(runs[:, k], pa.int64()) for k in range(3)], names=names)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(first, len(texts)).columns,
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items),
                        pa.array([t for _, t in answers], pa.binary()).cast(pa.string()),
                    ],
                    names=[f.name for f in schema.fields],
                )
                first += len(texts)

    return docs.select(*[named(f.name) for f in kept]).mapInArrow(made, schema)
