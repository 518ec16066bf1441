"""Every text query over whole tables against its SQL twin, or a plain version where SQL has none."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

from tests.compare import differences
from tests.conftest import DATA
from tests.llm import brute
from tripspark.llm.queries import QUERIES, SQL

TABLES = ("documents", "benchmark", "labels", "conversations", "embeddings")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return connection


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(SQL) == {
        "op2_compression_quality", "op3_license_scan", "op4_personal_data", "op12_simhash_links", "op13_periodic_runs",
    }


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, DATA), duck, SQL[name]) == ""


def test_licenses(spark, documents):
    rows = QUERIES["op3_license_scan"](spark, DATA).collect()
    assert len(rows) == len(documents)
    for r in rows:
        n, base = brute.licenses(documents[r["doc_id"]])
        places = [i for _, i in base]
        assert (r["n_words"], r["n_base"]) == (n, len(base))
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if base else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for label, _ in base}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_personal_data(spark, documents):
    rows = QUERIES["op4_personal_data"](spark, DATA).collect()
    assert len(rows) == len(documents)
    for r in rows:
        base = brute.personal(documents[r["doc_id"]])
        told = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(k == kind for k, _, _ in base) for kind in ("email", "ip", "card", "phone")
        ]
        assert set(told) <= set(r["spans"].split(","))


def test_quality_on_held_out_labels(spark):
    """On the largest table: smaller ones hold out only a handful of bad texts."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op2_compression_quality"](spark, folder)
    known = rows.where("held_out").join(labels, "doc_id").select("score", "quality", "predicted").collect()
    good = [r["score"] for r in known if r["quality"] == 1]
    bad = [r["score"] for r in known if r["quality"] == 0]
    assert len(good) > 500 and len(bad) > 80
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.97
    assert sum(r["predicted"] == r["quality"] for r in known) / len(known) > 0.93
    assert sum(r["predicted"] for r in known if r["quality"] == 1) / len(good) > 0.99
    assert sum(r["predicted"] for r in known if r["quality"] == 0) / len(bad) < 0.25
