"""Vector codes, SimHash links and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm import brute
from tests.llm.conftest import ODD_ROWS
from tripspark.llm import periodic_runs, simhash_links, vector_codes
from tripspark.llm.queries import QUERIES


def bag(rows):
    return sorted(map(repr, rows))


# Vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Plain Lloyd rounds in Python numbers: (id, code, error) and the codebooks."""
    whole = [(i, [int(np.floor(4096 * x)) for x in v]) for i, v in rows]
    width = len(whole[0][1]) // parts
    cut = [[v[j * width : (j + 1) * width] for j in range(parts)] for _, v in whole]
    books = [[cut[e][j] for e in range(min(entries, len(cut)))] for j in range(parts)]

    def assigned(j):
        return [min((sum((a - b) ** 2 for a, b in zip(v[j], c)), e) for e, c in enumerate(books[j])) for v in cut]

    for _ in range(rounds):
        for j in range(parts):
            codes = assigned(j)
            for e in range(len(books[j])):
                own = [v[j] for v, (_, c) in zip(cut, codes) if c == e]
                if own:
                    books[j][e] = [sum(x) // len(own) for x in zip(*own)]
    codes = [assigned(j) for j in range(parts)]
    return [(i, [c[n][1] for c in codes], sum(c[n][0] for c in codes)) for n, (i, _) in enumerate(whole)], books


def vector_rows(seed, n, length, spread):
    rng = random.Random(seed)
    centers = [[rng.uniform(-1, 1) for _ in range(length)] for _ in range(5)]
    return [(i, [float(np.float32(c + rng.gauss(0, spread))) for c in rng.choice(centers)]) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>, label int, n int, ids int, codes int, _id int, _values int, error int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, i % 3 if i else None, 1, 1, 1, 1, 1, 1) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("seed,n,length,spread", [(1, 120, 16, 0.05), (2, 90, 8, 1.0), (3, 7, 24, 0.3), (4, 200, 16, 0.0)])
def test_codes_like_plain_rounds(spark, seed, n, length, spread):
    rows = vector_rows(seed, n, length, spread)
    found, books = vector_codes.coded(vectors(spark, rows).repartition(3))
    wanted, plain_books = plain_codes(rows)
    assert [(r["id"], r["codes"], r["error"]) for r in found.orderBy("id").collect()] == wanted
    assert books.tolist() == plain_books


def test_balls_leave_out_only_what_cannot_win():
    rng = np.random.default_rng(5)
    own = rng.integers(-50, 50, (400, 4))
    old = rng.integers(-50, 50, (16, 4))
    book = old + rng.integers(-3, 4, (16, 4)) * (rng.random((16, 1)) < 0.5)
    away = ((own[:, None] - old[None]) ** 2).sum(axis=2)
    codes = away.argmin(axis=1)
    far = np.array([away[codes == e, e].max(initial=0) for e in range(16)])
    step = np.sqrt(((book - old) ** 2).sum(axis=1))
    balls = vector_codes.Balls(book[None], (np.sqrt(far) + step)[None] + 1e-6, (step > 0)[None])
    new, best = balls.nearest(0, own, codes)
    away = ((own[:, None] - book[None]) ** 2).sum(axis=2)
    assert (new == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def test_odd_vectors(spark):
    good = vector_rows(6, 30, 8, 0.2)
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, []), (102, [1.0, None] + [0.0] * 6), (103, [nan] * 8), (104, [0.0] * 7 + [inf]), (105, [1.0] * 5)]
    twice = good + good[:3] + [(None, good[4][1]), (106, [3e38] * 8)]
    found, _ = vector_codes.coded(vectors(spark, [(i if i is not None else 0, v) for i, v in twice + bad]))
    assert found.count() == len(twice) and found.where("error IS NULL OR error < 0").count() == 0
    none, books = vector_codes.coded(vectors(spark, good).limit(0))
    assert none.count() == 0 and books.size == 0
    odd, _ = vector_codes.coded(vectors(spark, [(i, v[:5]) for i, v in good]))  # 5 components for 8 parts
    assert odd.count() == len(good) and {len(r["codes"]) for r in odd.collect()} == {8}
    missing = vectors(spark, good).withColumn("vec_id", F.when(F.col("vec_id") != 3, F.col("vec_id")))
    assert vector_codes.coded(missing)[0].where("id IS NULL").count() == 1


# SimHash links


def plain_fingerprint(text):
    own = brute.words(text, brute.BLANKS)
    n = min(3, len(own))
    hashes = [xxhash.xxh64(" ".join(own[i : i + n]).encode(), seed=42).intdigest() for i in range(len(own) - n + 1)] if own else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    """Smallest id reachable for (id, fingerprint)."""
    least = {i: i for i, _ in prints}
    while True:
        low = {i: min(least[j] for j, q in prints if (p ^ q).bit_count() <= radius) for i, p in prints}
        low = {i: min(x, least[x]) for i, x in low.items()}
        if low == least:
            return least
        least = low


def test_links_on_the_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    least = plain_components(prints)
    found = {tuple(r) for r in QUERIES["op12_simhash_links"](spark, DATA).collect()}
    assert found == {(i, f"{p:016x}", least[i]) for i, p in prints}
    assert len(set(least.values())) < len(least)


def test_odd_texts_link(make):
    found = simhash_links.grouped(make(ODD_ROWS)).collect()
    assert len(found) == len(ODD_ROWS)
    prints = [(i, plain_fingerprint(t)) for i, t in ODD_ROWS]
    assert bag((r["doc_id"], r["fp"] % (1 << 64)) for r in found) == bag(prints)
    groups = {r["doc_id"]: r["component_id"] for r in found}
    assert groups[1] == groups[2] == groups[3] == 1 and groups[5] == groups[6] == 5 and groups[8] == 8
    assert simhash_links.grouped(make([])).count() == 0
    assert [r["component_id"] for r in simhash_links.grouped(make([(None, "lonely words here")])).collect()] == [None]


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"W{i % 91}\tx{i}" for i in range(900)).encode()
    whole = simhash_links.fingerprint(text)
    monkeypatch.setattr(simhash_links, "PIECE", 50)
    assert simhash_links.fingerprint(text) == whole == int(np.uint64(plain_fingerprint(text.decode())).view(np.int64))
    assert simhash_links.fingerprint(b"  one\ntwo ") % (1 << 64) == xxhash.xxh64(b"one two", seed=42).intdigest()


def test_every_pair_is_covered():
    masks = simhash_links.covering(list(range(64)), 2)
    assert len(masks) == 7
    for a in range(64):
        for b in range(a + 1):
            assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


@pytest.mark.parametrize("large", [1 << 13, 16])
def test_links_among_dense_fingerprints(spark, large):
    """A ball around one fingerprint, chains, and far ones; small buckets force the second level."""
    rng = random.Random(9)
    center = rng.getrandbits(64)
    prints = {center} | {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)}
    step = rng.getrandbits(64)
    for _ in range(12):
        prints.add(step := step ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints |= {rng.getrandbits(64) for _ in range(60)}
    rows = list(enumerate(sorted(prints)))
    signed = {int(np.uint64(p).view(np.int64)): i for i, p in rows}
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    pairs = [(signed[r["u"]], signed[r["v"]]) for r in simhash_links.links(df, large=large).collect()]
    by_id = dict(rows)
    assert all((by_id[a] ^ by_id[b]).bit_count() <= 2 for a, b in pairs)
    least = {i: i for i, _ in rows}
    for _ in rows:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert least == plain_components(rows)


# Periodic runs


def plain_runs(words, least=12):
    """Stretches of every period by comparison, the smallest period of equal ones."""
    best, n = {}, len(words)
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    own = np.array([numbers[w] for w in words])
    for p in range(1, n // 2 + 1):
        alike = np.concatenate(([0], own[:-p] == own[p:], [0])).astype(int)
        opens, ends = np.flatnonzero(np.diff(alike) == 1), np.flatnonzero(np.diff(alike) == -1)
        for s, e in zip(opens.tolist(), ends.tolist()):
            if e - s + p >= max(least, 2 * p):
                best.setdefault((s, e - s + p), p)
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_runs_on_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, DATA).collect()
    assert len(rows) == len(texts) and sum(r["n_runs"] for r in rows) > 10
    for r in rows:
        words = planted(r["doc_id"], brute.BLANKS.findall(texts[r["doc_id"]] or ""))
        runs = plain_runs(words)
        told = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        longest = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        milli = 1000 * longest[1] // longest[2] if runs else None
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *longest, milli)
        assert r["runs_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()


def test_runs_of_odd_texts(spark, make):
    texts = ["a " * 12, "a " * 11, "a b " * 6 + "a", "x " + "a b c " * 5 + "y " + "a b c " * 4, "ü\tü\nü " * 9, "a " * 30 + "b " + "a " * 30]
    rows = ODD_ROWS + [(50 + i, t) for i, t in enumerate(texts)] + [(50, texts[0]), (None, texts[3])]
    found = periodic_runs.with_runs(make(rows).withColumn("runs", F.lit(1))).select("doc_id", "text", "runs", "collapsed", "x").collect()
    assert bag((r["doc_id"], r["text"]) for r in found) == bag(rows) and {r["x"] for r in found} == {"x"}
    for r in found:
        words = brute.BLANKS.findall(r["text"] or "")
        runs = plain_runs(words) if len(words) < 5000 else [(0, 60_000, 997)]
        assert [tuple(x) for x in r["runs"]] == runs and r["collapsed"] == plain_collapsed(words, runs)
    assert periodic_runs.with_runs(make([])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_runs_like_comparison(seed):
    rng = random.Random(seed)
    for _ in range(60):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            letters, n = rng.choice([1, 2, 3, 5, 40]), rng.choice([0, 1, 5, 12, 30, 100, 200])
            text = [b"%d" % rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = rng.randrange(1, n - a + 1)
                text = [text[i] if i < a else text[a + (i - a) % p] for i in range(n)]
            texts.append(text * rng.choice([1, 1, 1, 2, 3]))
        least = rng.choice([12, 12, 2, 4])
        for text, (runs, _) in zip(texts, periodic_runs._answers(texts, least)):
            assert list(map(tuple, runs.tolist())) == plain_runs(text, least)


def test_levels_spell_the_words_and_extensions_agree():
    rng = np.random.default_rng(2)
    words = np.concatenate((rng.integers(0, 2, 300), np.tile(rng.integers(0, 3, 7), 40), [9, 9, 9, 10]))
    levels = periodic_runs.grammar(words)
    assert len(levels[-1].symbols) <= periodic_runs.TOP
    spelled = {}
    for level, above in zip(levels, levels[1:]):
        for k, symbol in enumerate(above.symbols.tolist()):
            children = tuple(level.symbols[level.first[k] : level.first[k + 1]].tolist())
            if children != (symbol,):
                assert spelled.setdefault(symbol, children) == children
    one, other = np.triu_indices(len(words), 1)
    chosen = rng.permutation(len(one))[:20_000]
    one, other = one[chosen], other[chosen]
    plain = [next(k for k in range(len(words)) if b + k >= len(words) or words[a + k] != words[b + k]) for a, b in zip(one, other)]
    assert periodic_runs.extensions(levels, one, other).tolist() == plain
