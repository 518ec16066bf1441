"""Joins, positions and pages with heavy keys, against plain joins and plain Python."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tripspark.operators import skew
from tripspark.operators.lists import pages
from tripspark.operators.ordering import number_in_groups, previous_in_group, with_dense_keys
from tripspark.operators.skew import fanout_left_join, hot_keys, lookup_join


@pytest.fixture(scope="module")
def left(spark):
    """Key (1, 'a') on a third of the rows, a third without key, the rest spread; many equal rows."""
    return spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")).alias("k"),
        F.when(F.col("id") % 3 != 2, "a").alias("t"),
        (F.col("id") % 2).alias("v"),
    )


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([(1, "a", "one"), (4, "a", "four"), (5, "b", "five")], "k BIGINT, t STRING, w STRING")


def test_finds_heavy_keys(left, force_hot):
    hot = hot_keys(left, ["k", "t"])
    heavy = left.where(skew.is_hot(left, ["k", "t"], hot)).select("k", "t").distinct()
    assert rows(heavy) == [(None, None), (1, "a")]
    assert len(hot) == 2 and all(0.3 < share < 0.4 for share in hot.values())


def test_few_rows_are_never_heavy(left):
    assert hot_keys(left, ["k", "t"]) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join(left, right, how, force_hot):
    keys = ["k", "t"]
    spread = lookup_join(left, right, keys, how)
    assert "_salt" in spread._jdf.queryExecution().logical().toString()
    expected = left.join(right, keys, how)
    assert spread.columns == expected.columns
    assert rows(spread) == rows(expected)


def test_keys_of_different_width(spark, left, force_hot):
    narrow = spark.createDataFrame([(1, "x")], "k INT, w STRING")
    joined = lookup_join(left.select("k", "v"), narrow, ["k"], "inner")
    assert joined.count() == 301 and "_salt" in joined._jdf.queryExecution().logical().toString()


def test_lookup_join_broadcasts_after_a_size_check(left, right, monkeypatch):
    joined = lookup_join(left, right, ["k", "t"], "left", check_size=True)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(skew, "SMALL_ROWS", 2)
    assert not skew.is_small(right)
    joined = lookup_join(left, right, ["k", "t"], "left", check_size=True)
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()


def test_fanout_left_join(left, right, force_hot):
    keys = ["k", "t"]
    one_per_key = right.union(right.sparkSession.createDataFrame([(None, None, "none"), (-7, "x", "alone")], right.schema))
    spread = fanout_left_join(one_per_key, left, keys)
    expected = one_per_key.join(left, keys, "left")
    assert "_salt" in spread._jdf.queryExecution().logical().toString()
    assert rows(spread) == rows(expected)


def test_heavy_key_is_cut(spark, force_hot):
    """The rows of one key leave the spreading in several pieces, even when they are equal."""
    same = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"))
    hot = hot_keys(same, ["k"])
    salted = skew._spread(same, skew.is_hot(same, ["k"], hot), 4)
    sizes = [r["count"] for r in salted.groupBy("_salt").count().collect()]
    assert len(sizes) > 1 and sum(sizes) == 4000


def test_positions(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), ((F.col("id") * 37) % 500).alias("o"))
    numbered = number_in_groups(df, ["g"], [F.floor(F.col("o") / 20)], ["o"])
    plain = df.withColumn("row_no", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert rows(numbered) == rows(plain)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.integers(0, 50))), min_size=1, max_size=80
    )
)
def test_previous_value(spark, force_hot, values):
    """With NULL groups, NULL places in the order, and ties."""
    df = spark.createDataFrame([(g, o, i) for i, (g, o) in enumerate(values)], "g INT, o INT, v INT")
    cut = previous_in_group(df, ["g"], ["o", "v"], "v", "p", F.floor(F.col("o") / 10))
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("g").orderBy("o", "v")))
    assert rows(cut) == rows(plain)


def test_dense_keys(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 100_003).alias("o"))
    keyed = with_dense_keys(df.repartition(7), ["o"], "id", start=41)
    found = [tuple(r) for r in keyed.orderBy("o").collect()]
    assert [k for k, _ in found] == list(range(42, 1042))


@pytest.mark.parametrize("distinct", [True, False])
@pytest.mark.parametrize("parts", [1, 7])
def test_pages(spark, distinct, parts):
    """Full pages in the order of the elements, whatever the partitioning; NULL groups and elements too."""
    values = [(0 if i < 700 else i % 5 or None, i % 30 or None) for i in range(1000)]
    found = pages(spark.createDataFrame(values, "g INT, e INT").repartition(parts), ["g"], ["e"], "es", 50, distinct).collect()
    by_group = {}
    for g, e in set(values) if distinct else values:
        by_group.setdefault(g, []).append(e)
    last = lambda e: (e is None, e or 0)  # noqa: E731  array_sort puts NULL last
    assert len(found) == sum(-(-len(es) // 50) for es in by_group.values())
    for g, es in by_group.items():
        own = sorted((r for r in found if r["g"] == g), key=lambda r: r["page"])
        assert [len(r["es"]) for r in own[:-1]] == [50] * (len(own) - 1)
        assert [e for r in own for e in r["es"]] == sorted(es, key=last)


def test_spreads_rows_with_maps(spark, force_hot):
    left = spark.range(400).select(F.lit(1).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    right = spark.createDataFrame([(1, "one")], "k INT, w STRING")
    assert lookup_join(left, right, ["k"], "inner").count() == 400


def test_heavy_key_search_has_no_single_task(left):
    """Summaries of tasks meet by groups of tasks."""
    groups = skew._summaries(left.repartition(6).select(skew.key_hash(left, ["k"]).alias("hash")), 4, 8)
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(_groupingexpression" in plan
