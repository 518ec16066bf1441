"""Mixing sources to target weights: token totals per source, repetition rates, and hash-seeded extra copies.

Sizes are words. Sources in order of their code points, null last, get the weights of `WEIGHTS` in turn. The mix shares
`SHARE` percent of all words by weight; a target stops at `MOST` times its source, and what is left over goes to the
others by weight. Each document then comes floor(rate) times, plus once more if a number drawn from its hash is below the
fraction.

A hot source costs nothing extra: totals are summed before the shuffle, and one row per source is joined back.

Cases: a null or empty text has size 0. Documents that are equal in id and text draw the same number, so repeated rows
share their fate and a run again gives the same mix. An empty table gives no rows. Other columns pass through `mixed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.frames import named, stored, whole_text, word_count

WEIGHTS = (3, 1, 2)
SHARE = 150
MOST = 2
SEED = 20240517
STEPS = 1 << 48  # steps of the drawn number
MAX_BROADCAST = 100_000  # rows of (source, five numbers); with more sources the join goes by source and salt
SALTS = 64


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """From rows (source, size): one row per source with source_size, weight, target and rate.

    A target is the smaller of weight * level and MOST * source_size, with the level at which the targets add up to the
    share. Sources reach their limit in order of MOST * size / weight, so running sums in that order give, for each
    source, the level that holds if all before it stop at their limits. The windows hold one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    limit = (F.lit(MOST) * F.col("source_size")).cast("double")
    ranked = totals.withColumn("weight", weight.cast("long")).withColumn("limit", limit)
    ranked = ranked.withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    shared = F.sum("source_size").over(everything).cast("double") * F.lit(SHARE / 100)
    level = (shared - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    ranked = ranked.withColumn("level", level)
    # The first source that its level leaves below the limit sets the level for itself and all after it.
    final = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    target = F.least(F.col("limit"), F.coalesce(F.col("weight") * final, F.col("limit")))
    made = ranked.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST))))
    return made.select("source", "source_size", "weight", "target", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def drawn(key: Column, text: Column, seed: int = SEED) -> Column:
    """A number from 0 (included) to 1 (excluded) that depends on seed, key and text alone."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.coalesce(key.cast("string"), F.lit("")), text)), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(STEPS))


def planned(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED
) -> DataFrame:
    """All rows as a struct `row`, with size, source_size, target, rate and copies."""
    sized = df.select(
        F.struct("*").alias("row"),
        named(source).alias("source"),
        word_count(whole_text(text)).alias("size"),
        drawn(named(key), whole_text(text), seed).alias("draw"),
    )
    targets = stored(
        source_targets(df.select(named(source).alias("source"), word_count(whole_text(text)).alias("size"))),
        "source-targets",
    ).withColumnRenamed("source", "of")
    if targets.count() <= MAX_BROADCAST:
        joined = sized.join(F.broadcast(targets), sized["source"].eqNullSafe(targets["of"]))
    else:
        sized = sized.withColumn("salt", (F.col("draw") * SALTS).cast("int"))
        salted = targets.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = sized.join(salted, sized["source"].eqNullSafe(salted["of"]) & (sized["salt"] == salted["part"]))
    whole = F.floor("rate")
    copies = whole + F.when(F.col("draw") < F.col("rate") - whole, 1).otherwise(0)
    return joined.select("row", "size", "source_size", "target", "rate", copies.cast("int").alias("copies"))


def mixed(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED
) -> DataFrame:
    """The mix itself: every row as often as planned, with its own columns."""
    plan = planned(df, key, text, source, seed)
    return plan.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
