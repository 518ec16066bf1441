"""Nulls, empty and long texts, repeated rows, empty tables and columns with clashing names, for every operator."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import ODD_ROWS
from tripspark.llm import (
    backoff_scores,
    chat_format,
    compression_classifier,
    decontamination,
    license_scan,
    mixture,
    near_duplicates,
    personal_data,
    quality_rules,
    repeated_spans,
)
from tripspark.llm.packed import rising
from tripspark.llm.queries import QUERIES
from tripspark.llm.text_blocks import grams

BENCHMARK = [(1, "a few words in it so that it has"), (2, "one two three"), (None, None), (3, "")]


@pytest.fixture(scope="module")
def odd(make):
    return make(ODD_ROWS)


@pytest.fixture(scope="module")
def empty(make):
    return make([])


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(BENCHMARK, "item_id long, text string")


def bag(rows):
    return sorted(map(repr, rows))


def test_backoff(odd, empty):
    found = backoff_scores.scored(odd).select("doc_id", "n_words", "n_full", F.round("score", 6)).collect()
    wanted = [(i, *r) for (i, _), r in zip(ODD_ROWS, brute.backoff(ODD_ROWS))]
    assert bag(map(tuple, found)) == bag(wanted)
    assert backoff_scores.scored(empty).count() == 0


def test_rising_is_the_stable_order():
    rng = np.random.default_rng(3)
    far = rng.integers(0, 1 << 64, 1000, dtype=np.uint64)
    near = np.uint64(7 << 50) + rng.integers(0, 4, 500, dtype=np.uint64)  # the upper bits of many are equal
    ends = np.array([(1 << 64) - 1, 0, (1 << 64) - 1, 1, 0], dtype=np.uint64)
    for keys in (far, near, ends, near[:0], near[:1], near[:2], far[[5] * 9], np.concatenate((far, near, ends, far))):
        assert np.array_equal(rising(keys), np.argsort(keys, kind="stable"))


def test_backoff_orders_the_ngrams_once(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefgh", k=400)) for _ in range(9)] + ["", None, "a b", "a b a b a b"]
    words = backoff_scores._all_words(pa.chunked_array([texts]))
    occurring = {n: grams(words, n)[0] for n in (1, 2, 3)}
    tables = {n: Counter(own.tolist()) for n, own in occurring.items()}
    for n, own in occurring.items():
        counts = np.arange(len(own))
        sums = Counter()
        for g, c in zip(own.tolist(), counts.tolist()):
            sums[g] += c
        assert backoff_scores._totals(own, counts).tolist() == [sums[g] for g in own.tolist()], n

    sorted_again, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda rows, *a, **k: sorted_again.append(len(rows)) or unique(rows, *a, **k))
    known = lambda n, own: np.array([tables[n][g] for g in own.tolist()])
    full, total = backoff_scores._scores(words, known, 3, len(words.doc))
    assert sum(sorted_again) < len(words.doc)  # was six times as many as there are words
    for (n_words, n_full, score), f, t in zip(brute.backoff([(0, text) for text in texts]), full, total):
        assert (n_full, score) == (f, round(t / n_words, 6) if n_words else None)


def test_classifier_without_labels(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (4, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    model = compression_classifier.trained(odd, labels)
    scores = compression_classifier.scored(odd, model, into="p").select("p").collect()
    assert len(scores) == len(ODD_ROWS) and all(0 <= r["p"] <= 1 for r in scores)
    assert compression_classifier.scored(empty, compression_classifier.trained(empty, labels.limit(0)), into="p").count() == 0


def test_classifier_never_reads_held_out_labels(spark, make):
    rows = [(i, ("plain words of prose go here " if i % 2 else "$$$ ### !!! BUY NOW ") * 8) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    fold = compression_classifier.fold(F.col("doc_id"))
    turned = labels.withColumn("quality", F.when(fold == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    docs = make(rows)
    assert compression_classifier.trained(docs, labels) == compression_classifier.trained(docs, turned)


def test_curve_is_the_best_rising_one():
    xs, ys = [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0], [0, 1, 0, 0, 1, 0, 1]
    steps = compression_classifier._rising(xs, ys)
    assert steps == ((1.0, 0.0), (2.0, 1 / 3), (3.0, 1 / 3), (4.0, 0.5), (5.0, 0.5), (6.0, 1.0))
    model = compression_classifier.CompressionModel(slope=1.0, steps=steps)
    places = [x / 10 for x in range(-5, 90)]
    values = [model.probability(x) for x in places]
    assert values == sorted(values) and len(set(values)) == len(values) and 0 <= values[0] and values[-1] <= 1


def test_licenses(odd, empty, make):
    found = license_scan.scanned(odd, into="found_licenses").select("doc_id", "found_licenses").collect()
    assert len(found) == len(ODD_ROWS)
    assert license_scan.scanned(empty, into="l").count() == 0
    (row,) = license_scan.scanned(
        make([(1, "Licensed under the Apache License, Version 2.0. CC BY-NC 4.0; all rights reserved.")]), into="l"
    ).select("l").collect()
    labels = [d["label"] for d in row["l"]["found"]]
    assert labels == ["apache-2", "cc-by-nc-4", "all-rights-reserved"]
    assert [b["label"] for b in row["l"]["base"]] == ["apache-2", "cc-by-nc"]


def test_license_rules_are_many_and_ordered():
    rules = license_scan.rules()
    assert len(rules) > 200 and [r.priority for r in rules] == sorted(r.priority for r in rules)
    assert len({r.name for r in rules}) == len(rules)


def test_personal_data(odd, empty, make):
    assert personal_data.found(odd).count() == len(ODD_ROWS)
    assert personal_data.redacted(empty).count() == 0 and personal_data.redacted(odd).columns == odd.columns
    text = "Write to a.b@example.org or +1 (555) 123-4567, host 10.1.2.3, card 4111 1111 1111 1111; not 999.1.1.1"
    (row,) = personal_data.redacted(make([(1, text)]), model=personal_data.SpanModel()).collect()
    assert row["text"] == "Write to [EMAIL] or [PHONE], host [IP], card [CARD]; not 999.1.1.1"
    assert {r["text"] for r in personal_data.redacted(odd).where("doc_id = 1").collect()} == {None}


HARD = ["a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "+1 234 567 8901 4111111111111111", "ü 1.2.3.4@x.y.z", "0000255.1.1.1", "a@b..c", "++1 555 123 4567"]


def test_base_spans_like_leftmost_matches(make):
    random.seed(3)
    texts = HARD + ["".join(random.choices("ab@.+-0123456789 ()é", k=120)) for _ in range(300)]
    rows = personal_data.found(make(list(enumerate(texts)))).select("row.text", "spans").collect()
    for r in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]] == brute.personal(r["text"])


def test_expectation_maximisation_prefers_agreement():
    good = tuple(f"card/{n}=1" for n in personal_data.LABELERS) + ("card/length=2", "card/sides=0")
    bad = tuple(f"card/{n}=-1" for n in personal_data.LABELERS) + ("card/length=1", "card/sides=3")
    model = personal_data.fitted([(good, 900), (bad, 400)])
    assert all(model.reliability[f] > 0 for f in good[:4]) and all(model.reliability[f] < 0 for f in bad[:4])
    assert sum(model.weights[f] for f in good) > 0 > sum(model.weights[f] for f in bad)


def test_mix(odd, empty):
    plan = mixture.planned(odd).collect()
    assert len(plan) == len(ODD_ROWS) and all(0 <= r["copies"] <= 2 for r in plan)
    assert mixture.mixed(empty).count() == 0 and mixture.mixed(odd).columns == odd.columns
    assert bag(map(tuple, mixture.mixed(odd).collect())) == bag(map(tuple, mixture.mixed(odd.repartition(5)).collect()))


def test_targets_stop_at_twice_the_source(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 500), (None, 0)], "source string, size long")
    rows = {r["source"]: r for r in mixture.source_targets(sizes).collect()}
    assert rows["b"]["target"] == 20 and rows[None]["target"] == 0
    assert abs(sum(r["target"] for r in rows.values()) - 1.5 * 1510) < 1e-6
    assert rows["a"]["weight"] == 3 and rows["b"]["weight"] == 1 and rows["c"]["weight"] == 2 and rows[None]["weight"] == 3


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', 1 + id % 9) AS text", "concat('s', id % 3) AS source")
    taken = mixture.planned(docs).groupBy("row.source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.first("target").alias("t"))
    assert all(abs(r["n"] - r["t"]) < 0.03 * r["t"] for r in taken.collect())


def test_joins_by_source_and_salt_beyond_the_broadcast_bound(odd, monkeypatch):
    plain = bag(map(tuple, mixture.planned(odd).drop("row").collect()))
    monkeypatch.setattr(mixture, "MAX_BROADCAST", 0)
    assert bag(map(tuple, mixture.planned(odd).drop("row").collect())) == plain


def test_duplicates(odd, empty):
    found = near_duplicates.grouped(odd).collect()
    assert len(found) == len(ODD_ROWS)
    plain = brute.components([r for r in dict(ODD_ROWS).items() if r[0] is not None])
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == plain[r["doc_id"]]
    assert near_duplicates.grouped(empty).count() == 0
    kept = near_duplicates.without_duplicates(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 7, 8, None}


def near_copies(seed, groups, passage):
    """Groups of edited copies, chains of copies of copies, and a passage that most texts share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    shared, rows = [f"p{i}" for i in range(passage)], []
    for g in range(groups):
        own = rng.choices(vocabulary, k=rng.choice([3, 8, 30, 90, 160]))
        at = rng.randrange(len(own) + 1)
        own = own[:at] + (shared if g % 3 else []) + own[at:]
        copy = own
        for c in range(rng.choice([1, 2, 5, 40])):
            source = copy if rng.random() < 0.3 else own
            copy = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.005, 0.02, 0.04]) else w for w in source]
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,groups,passage,dear", [(1, 25, 40, 24), (2, 30, 90, 3), (3, 20, 12, 6)])
def test_groups_like_all_pairs(make, seed, groups, passage, dear):
    rows = near_copies(seed, groups, passage)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.grouped(make(rows), dear=dear).collect()}
    assert found == brute.components(rows)


@pytest.mark.parametrize("block,pivots,wide", [(8, 2, 4), (8, 0, 16), (16, 4, 1024)])
def test_families_of_several_blocks(make, monkeypatch, block, pivots, wide):
    """Members meet in their block, by pivots, or by their sketches: the groups are the same."""
    for name, value in (("FAMILY_BLOCK", block), ("PIVOTS", pivots), ("WIDE", wide)):
        monkeypatch.setattr(near_duplicates, name, value)
    rng = random.Random(block + wide)
    vocabulary = [f"w{i}" for i in range(3000)]
    shared, rows = [f"p{i}" for i in range(90)], []
    for size, rate, length in ((120, 0.02, 60), (60, 0.035, 300), (40, 0.01, 20)):
        own = shared + rng.choices(vocabulary, k=length)
        rows += [" ".join(rng.choice(vocabulary) if rng.random() < rate else w for w in own) for _ in range(size)]
    rows = list(enumerate(rows))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.grouped(make(rows)).collect()}
    assert found == brute.components(rows)


def test_sketches_never_rule_out_links():
    rng = np.random.default_rng(5)
    for n in (1, 4, 7, 60, 900):
        pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        for _ in range(40):
            one, other = (np.unique(rng.choice(pool, rng.integers(1, n + 1), replace=False)) for _ in range(2))
            if rng.random() < 0.7:
                other = np.unique(np.concatenate([one[rng.random(len(one)) > 0.1], other[: n // 12]]))
            common = len(np.intersect1d(one, other))
            linked = common > 0 and 180 * common >= 80 * (len(one) + len(other))
            for bits in (64, 256, 4096):
                a, b = (np.frombuffer(near_duplicates.sketch(s, bits), dtype=np.uint64) for s in (one, other))
                differ = int(np.bitwise_count(a ^ b).sum())
                assert differ <= len(one) + len(other) - 2 * common
                assert not linked or differ <= near_duplicates.may_differ(np.int64(len(one)), np.int64(len(other)))
                half = len(np.frombuffer(near_duplicates.sketch(one, bits), np.uint64)) // 2
                if half:
                    assert (a[:half] ^ a[half:]).tobytes() == near_duplicates.sketch(one, bits // 2)


def test_decontamination(odd, empty, benchmark):
    marked = decontamination.marked(odd, benchmark, into="m2").select("doc_id", "text", "m2").collect()
    plain = brute.hits([(i, t) for i, t in enumerate(r["text"] for r in marked)], [(i if i is not None else "", t) for i, t in BENCHMARK])
    for i, r in enumerate(marked):
        mark = r["m2"]
        assert (mark["n_words"], sum(x["last"] - x["first"] for x in mark["runs"]), mark["items"]) == plain[i]
    assert decontamination.marked(empty, benchmark, into="m2").count() == 0
    none = decontamination.marked(odd, benchmark.limit(0), into="m2").where("size(m2.runs) > 0")
    assert none.count() == 0
    kept = decontamination.cleaned(odd, benchmark, drop_documents=True)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, None, 7, 8}
    cut = decontamination.cleaned(odd, benchmark)
    assert {r["text"] for r in cut.where("doc_id = 5").collect()} == {"same text here with  shingles"}


def test_decontamination_query_with_clashing_columns(spark, odd, benchmark, tmp_path):
    clashing = odd.withColumns({c: F.lit(1) for c in ("mark", "m0", "row", "new", "x")})
    clashing.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = QUERIES["op9_decontamination"](spark, str(tmp_path))
    assert found.count() == len(ODD_ROWS) and found.where("contaminated").count() > 0
    replaced = decontamination.marked(clashing, benchmark, into="mark")
    assert replaced.columns == [c for c in clashing.columns if c != "mark"] + ["mark"]
    assert replaced.select("mark.n_words").count() == len(ODD_ROWS)


def test_chat_loss_follows_the_flags(spark):
    """The digest comes from the segments under the mask, not from the roles."""
    rows = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")
    made = chat_format.formatted(rows).withColumn("loss", chat_format.loss_text(F.col("segments"))).collect()
    assert {r["conv_id"]: r["loss"] for r in made} == {1: "yo\n<|im_end|>\n", 2: "", None: "", 3: "", 4: "a"}


def test_blocks_of_benchmark_items_give_the_same(odd, benchmark):
    one = decontamination.marked(odd, benchmark, into="m2").select("doc_id", "m2").collect()
    many = decontamination.marked(odd, benchmark, into="m2", max_windows=8).select("doc_id", "m2").collect()
    assert bag(one) == bag(many)


def test_repeated_spans(odd, empty, spark):
    found = repeated_spans.spans(odd).drop("text_hash", "spans").collect()
    wanted = [(i, *r) for (i, _), r in zip(ODD_ROWS, brute.repeated(ODD_ROWS))]
    assert bag(map(tuple, found)) == bag(wanted)
    assert repeated_spans.spans(empty).count() == 0
    clean = repeated_spans.cleaned(odd)
    assert clean.columns == odd.columns and clean.count() == len(ODD_ROWS)
    assert [r["text"] for r in clean.where("doc_id = 6").collect()] == ["", ""]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_spans_of_mixed_texts(make, seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choices("abcdé \n", k=rng.choice([20, 49, 50, 51, 120]))) for _ in range(12)] + ["a" * 200, "ab" * 60]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 20])))) for i in range(60)]
    found = {r["doc_id"]: tuple(r)[1:] for r in repeated_spans.spans(make(rows), piece=700).drop("text_hash", "spans").collect()}
    assert found == {i: r for (i, _), r in zip(rows, brute.repeated(rows))}


CHAT = [
    (1, 0, "user", "hi"),
    (1, 1, "assistant", "yo\n<|im_end|>\n"),
    (2, 0, None, None),
    (2, None, "user", "\\<|\\\\|<\\|"),
    (None, 0, "assistant", ""),
    (3, 0, "a\nb\\n<|", "x"),
    (3, 0, "a\nb\\n<|", "x"),
    (4, 0, "system", "be\\brief"),
    (4, 1, "user", "q"),
    (4, 2, "assistant", "a"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    made = chat_format.formatted(rows).withColumn("back", chat_format.parsed(F.col("formatted"))).collect()
    for r in made:
        own = [t for t in CHAT if t[0] == r["conv_id"]]
        own.sort(key=lambda t: ((t[1] is not None, t[1] or 0), t[2] or "", t[3] or ""))
        assert [(b["role"], b["text"]) for b in r["back"]] == [(t[2] or "", t[3] or "") for t in own]
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert [s["loss"] for s in r["segments"][1::3]] == [t[2] == "assistant" for t in own]
    valid = {r["conv_id"]: (r["valid"], r["bad_turn"]) for r in made}
    assert valid == {1: (True, None), 2: (False, 1), None: (False, 0), 3: (False, 0), 4: (True, None)}
    assert chat_format.formatted(rows.limit(0)).count() == 0


def test_quality_rules(odd, empty):
    found = quality_rules.judged(odd).collect()
    assert len(found) == len(ODD_ROWS) and not any(r["kept"] for r in found if r["n_words"] < 50)
    assert quality_rules.judged(empty).count() == 0
