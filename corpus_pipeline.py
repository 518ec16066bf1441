"""Corpus pipeline: documents through five of the text operators, each stage written and read again.

`run` gives the mix that training would read: documents without low quality, near copies, benchmark passages and personal
data, repeated by the weights of their sources. Each stage takes whatever rows its predecessor kept and gives the columns
of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm import compression_classifier, decontamination, mixture, near_duplicates, personal_data
from tripspark.llm.frames import stored, table
from tripspark.llm.shipping import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the classifier, trained on the labelled ones among them, doesn't reject."""
    ship(spark)
    model = compression_classifier.trained(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), compression_classifier.score(F.col("text"), model).alias("score"))
    return rows.where(F.col("score") >= compression_classifier.THRESHOLD).select("row.*")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    ship(spark)
    return near_duplicates.without_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    ship(spark)
    return decontamination.cleaned(docs, table(spark, sf_dir, "benchmark"), drop_documents=True)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in place of personal data; n_chars follows the text."""
    clean = personal_data.redacted(docs)
    if "n_chars" in docs.columns:
        kept = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", kept)
    return clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents by the target weights of their sources."""
    return mixture.mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("n-gram jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("personal data", redact),
    ("source mix", mix),
]

#: The classifier compresses texts and the personal data stage trains a model: neither is SQL. The tests run a plain
#: Python version over a small table instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
