from __future__ import annotations

import pytest

from tripspark.llm.shipping import ship


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship(spark)


SCHEMA = "doc_id long, text string, source string, row string, x string, id string, score string, mark string, spans string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with columns whose names the operators use themselves."""

    def made(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "r", "x", "i", "s", "m", "p") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return made


LONG = " ".join(f"word{i % 997}" for i in range(60_000))
ODD_ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one two three"),
    (5, "same text here with a few words in it so that it has shingles"),
    (6, "same text here with a few words in it so that it has shingles"),
    (6, "same text here with a few words in it so that it has shingles"),
    (None, "same text here with a few words in it so that it has shingles"),
    (None, None),
    (7, LONG),
    (8, "naïve Ünïcode текст 中文 \U0001f600 emoji"),
]
