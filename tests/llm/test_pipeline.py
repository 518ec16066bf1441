"""The pipeline against a plain version of each stage, stage by stage, over the whole small table."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import DATA
from tests.llm import brute
from tripspark.llm import compression_classifier, mixture
from tripspark.llm.frames import stored, table


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, DATA, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], DATA), "test-stage"))
    return docs


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_keep_columns(spark, steps):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert all(s.columns == steps[0].columns for s in steps)


def test_quality(spark, steps):
    model = compression_classifier.trained(steps[0], table(spark, DATA, "labels"))
    texts = {i: r["text"] for i, r in rows(steps[0]).items()}
    good = {i for i, t in texts.items() if model.probability(model.differences([(t or "").encode()])[0]) >= 0.3}
    assert set(rows(steps[1])) == good and len(good) < len(texts)


def test_duplicates(steps):
    before = rows(steps[1])
    wanted = {c for _, c in brute.components([(i, r["text"]) for i, r in before.items()]).values()}
    assert set(rows(steps[2])) == wanted < set(before)


def test_contamination(spark, steps):
    items = [(r["item_id"], r["text"]) for r in table(spark, DATA, "benchmark").collect()]
    before = rows(steps[2])
    found = brute.hits([(i, r["text"]) for i, r in before.items()], items)
    assert set(rows(steps[3])) == {i for i, (_, n, _) in found.items() if n == 0} < set(before)


def test_personal_data(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert set(before) == set(after)
    touched = [i for i, r in before.items() if brute.personal(r["text"])]
    assert touched and not any(brute.personal(r["text"]) for r in after.values())
    assert all(after[i]["n_chars"] == len(after[i]["text"]) for i in after)
    same = [i for i in before if before[i]["text"] == after[i]["text"]]
    assert len(same) > 0.7 * len(before)


def test_mix(steps):
    before = steps[4].collect()
    size = {r["doc_id"]: len(brute.words(r["text"], brute.BLANKS)) for r in before}
    totals = {}
    for r in before:
        totals[r["source"]] = totals.get(r["source"], 0) + size[r["doc_id"]]
    sources = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    target, free, left = {}, set(sources), 1.5 * sum(totals.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 2 * totals[s]}
        if not full:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: 2.0 * totals[s] for s in full}
        left -= sum(2 * totals[s] for s in full)
        free -= full
    counts = {r["doc_id"]: r["n"] for r in steps[5].groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for r in before:
        rate = min(2.0, target[r["source"]] / totals[r["source"]])
        draw = int(hashlib.md5(f"{mixture.SEED}:{r['doc_id']}:{r['text']}".encode()).hexdigest()[:12], 16) / 2**48
        assert counts.get(r["doc_id"], 0) == int(rate) + (draw < rate - int(rate))


def test_run_gives_the_same(spark, steps):
    found = corpus_pipeline.run(spark, DATA)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, steps[5].collect()))
