"""Quality by compression: two zstandard dictionaries, one trained on good and one on bad labelled text.

A text is compressed with each. The difference of the two sizes per byte says which text it resembles; a curve, fitted on
labelled texts that trained no dictionary, turns that into a probability of label 1. With `ENOUGH` texts of each class the curve
is the rising step function that fits them best (pool adjacent violators), joined by lines and mixed with a little of a
logistic curve, so that it never stands still; with fewer it is the logistic curve.

The fit reads a bounded sample: at most `SAMPLE` labelled rows of each class, the same for any partitioning (lowest hash
first), from texts of at most `FIT_CHARS` code points. They are found by a broadcast of the sampled ids (at most
2 * SAMPLE) and come to the driver; dictionaries of at most `DICTIONARY` bytes go to the tasks. Every text is scored
whole where it lies; nothing is shuffled.

Cases: null and empty texts compress alike with both and get the curve's value at 0. Rows with a null id teach nothing
and are not held out. Conflicting labels of one id all count. Without labels of both classes every score is the share of
label 1 among those sampled (0.5 without any). Repeated rows get equal scores; an empty table gives no rows. Other
columns pass through `scored`.
"""

from __future__ import annotations

import bisect
import itertools
import math
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.llm.frames import named

FOLDS = 5
HELD_OUT = 0
CALIBRATION = 4  # this fold fits the curve, the others the dictionaries
SAMPLE = 4_000
FIT_CHARS = 50_000
DICTIONARY = 110 << 10  # bytes, or a quarter of the smaller class where that is less
PIECE = 4_000  # bytes; training works on many short samples, not on few long ones
LEVEL = 3
THRESHOLD = 0.3
ENOUGH = 30  # texts of a class that the step function needs
LOGISTIC_SHARE = 0.02


def fold(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(FOLDS))


@dataclass(frozen=True)
class CompressionModel:
    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    offset: float = 0.0
    steps: tuple[tuple[float, float], ...] = ()  # rising (difference, probability)
    level: int = LEVEL

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        def made(content: bytes) -> zstandard.ZstdCompressor:
            kind = zstandard.DICT_TYPE_AUTO if content else zstandard.DICT_TYPE_RAWCONTENT
            if not content:
                return zstandard.ZstdCompressor(level=self.level)
            return zstandard.ZstdCompressor(
                level=self.level,
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind),
                write_checksum=False,
                write_dict_id=False,
            )

        return made(self.good), made(self.bad)

    def differences(self, texts: list[bytes]) -> list[float]:
        good, bad = self.compressors()
        found = []
        for text in texts:
            a, b = len(good.compress(text)), len(bad.compress(text))
            found.append((b - a) / len(text) if text else 0.0)
        return found

    def probability(self, difference: float) -> float:
        z = max(-40.0, min(40.0, self.offset + self.slope * difference))
        smooth = 1 / (1 + math.exp(-z))
        return (1 - LOGISTIC_SHARE) * self._stepped(difference) + LOGISTIC_SHARE * smooth if self.steps else smooth

    def _stepped(self, difference: float) -> float:
        after = bisect.bisect_right(self.steps, (difference, math.inf))
        if after in (0, len(self.steps)):
            return self.steps[min(after, len(self.steps) - 1)][1]
        (x, p), (y, q) = self.steps[after - 1], self.steps[after]
        return p + (q - p) * (difference - x) / (y - x)


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on pieces of the samples, or the samples themselves where there are too few to train one."""
    pieces = [s[i : i + PIECE] for s in samples for i in range(0, len(s), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def fitted(rows: list[tuple[bytes, int, bool]], size: int = DICTIONARY) -> CompressionModel:
    """From rows (text, label, whether the row is for the curve)."""
    labels = [y for _, y, _ in rows]
    share = (sum(labels) + 1) / (len(labels) + 2)
    if len(set(labels)) < 2:
        return CompressionModel(offset=math.log(share / (1 - share)))
    teach = [r for r in rows if not r[2]]
    if len({y for _, y, _ in teach}) < 2:
        teach = rows
    good, bad = [t for t, y, _ in teach if y == 1 and t], [t for t, y, _ in teach if y != 1 and t]
    size = min(size, max(1024, min(sum(map(len, good)), sum(map(len, bad))) // 4))
    model = CompressionModel(_dictionary(good, size), _dictionary(bad, size))
    curve = [r for r in rows if r[2]]
    if len({y for _, y, _ in curve}) < 2:
        curve = rows
    xs, ys = model.differences([t for t, _, _ in curve]), [y for _, y, _ in curve]
    slope, offset = _logistic(xs, ys)
    steps = _rising(xs, ys) if min(sum(ys), len(ys) - sum(ys)) >= ENOUGH and slope > 0 else ()
    return CompressionModel(model.good, model.bad, slope, offset, steps)


def _rising(xs: list[float], ys: list[int]) -> tuple[tuple[float, float], ...]:
    """Pool adjacent violators: first and last place of each level of the best rising step function, with its value."""
    levels: list[list[float]] = []  # first place, last place, sum, count
    for x, same in itertools.groupby(sorted(zip(xs, ys)), key=lambda r: r[0]):
        own = [y for _, y in same]
        levels.append([x, x, sum(own), len(own)])
        while len(levels) > 1 and levels[-2][2] * levels[-1][3] >= levels[-1][2] * levels[-2][3]:
            _, last, total, count = levels.pop()
            levels[-1][1:] = [last, levels[-1][2] + total, levels[-1][3] + count]
    return tuple((x, total / count) for a, b, total, count in levels for x in dict.fromkeys((a, b)))


def _logistic(xs: list[float], ys: list[int], steps: int = 50, ridge: float = 1e-4) -> tuple[float, float]:
    """Newton's method for one feature; the ridge keeps separable classes finite."""
    scale = max(max(abs(x) for x in xs), 1e-9)
    a = b = 0.0
    for _ in range(steps):
        ga, gb, haa, hab, hbb = ridge * len(xs) * a, 0.0, ridge * len(xs), 0.0, 1e-9
        for x, y in zip(xs, ys):
            u = x / scale
            p = 1 / (1 + math.exp(-max(-40.0, min(40.0, a * u + b))))
            w = max(p * (1 - p), 1e-9)
            ga += (p - y) * u
            gb += p - y
            haa += w * u * u
            hab += w * u
            hbb += w
        det = haa * hbb - hab * hab
        if abs(det) < 1e-18:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-9:
            break
    return a / scale, b


def trained(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> CompressionModel:
    """Learns from labelled rows outside the held-out fold."""
    known = labels.select(named(key).alias("id"), named(label).cast("int").alias("y")).where(
        F.col("y").isNotNull() & (fold(F.col("id")) != HELD_OUT)
    )
    chosen = [
        known.where(F.col("y") == 1 if good else F.col("y") != 1).orderBy(F.xxhash64("id"), "id", "y").limit(sample)
        for good in (True, False)
    ]
    ids = chosen[0].unionByName(chosen[1])
    texts = docs.select(named(key).alias("id"), named(text).alias("x")).where(F.length("x") <= FIT_CHARS)
    rows = texts.join(F.broadcast(ids), "id").select("x", "y", (fold(F.col("id")) == CALIBRATION).alias("curve"))
    found = [(r["x"].encode(), 1 if r["y"] == 1 else 0, r["curve"]) for r in rows.collect()]
    return fitted(sorted(found))


def score(text: Column, model: CompressionModel) -> Column:
    """Probability of label 1, for whole texts."""

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        plain = pc.fill_null(texts, "").cast(pa.large_binary())
        return pa.array([model.probability(d) for d in model.differences([x.as_py() for x in plain])], pa.float64())

    return scored(text)


def scored(
    docs: DataFrame, model: CompressionModel, text: str = "text", into: str = "score"
) -> DataFrame:
    return docs.withColumn(into, score(named(text), model))
