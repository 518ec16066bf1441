"""Quality rules: one threshold table compiled into one Spark projection.

`RULES` names a measure and the closed range in which a text passes. `judged` turns the table into column expressions;
nothing leaves the JVM and nothing is shuffled, so a text costs the same wherever it lies.

Cases: a text that is null or empty has no words, so it fails the base rule. Measures that divide by zero count as
passed. Repeated rows and ties are judged row by row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.frames import WORD, named, whole_text, words_of

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated windows

# Frequent function words of the four languages, sought as they stand here, in lower case.
STOP_WORDS = (
    "the be to of and that have with is in it for on as at by "
    "der die das und ist von zu den mit ein eine im auf für "
    "le la les de des et un une que qui dans est pour du "
    "el los las y en que del se por con una su es para"
).split()


@dataclass(frozen=True)
class Rule:
    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_length", "mean_word_length", 2.0, 20.0),
    Rule("symbols_per_word", "symbols_per_word", None, 0.3),
    Rule("upper_case_share", "upper_case_share", None, 0.5),
    Rule("exclamations_per_word", "exclamations_per_word", None, 0.5),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("repeated_lines_share", "repeated_lines_share", None, 0.5),
    Rule("bullet_lines_share", "bullet_lines_share", None, 0.9),
    Rule("ellipsis_lines_share", "ellipsis_lines_share", None, 0.3),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def measured(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep` and every measure of the rules."""
    x = F.col("x")
    words, lines, windows, repeats, starts = (F.col(n) for n in ("words", "lines", "windows", "repeats", "starts"))
    base = df.select(*[named(k).alias(f"k{i}") for i, k in enumerate(keep)], whole_text(text).alias("x"))
    base = base.withColumns(
        {
            "words": words_of(x),
            "lines": F.filter(F.split(x, "\n", -1), lambda line: line.rlike(WORD)),
        }
    )
    base = base.withColumn(
        "windows",
        F.transform(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
        ),
    )
    # Windows sorted by hash, only where some hash occurs twice.
    base = base.withColumn(
        "repeats",
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda e, k: e["h"].eqNullSafe(F.get(repeats, k)["h"])
    base = base.withColumn(
        "starts",
        F.array_sort(
            F.filter(
                F.transform(repeats, lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["i"])),
                lambda i: i.isNotNull(),
            )
        ),
    )
    covered = F.aggregate(
        F.transform(starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3)))),
        F.lit(0),
        lambda a, n: a + n,
    )
    n_words = F.size(words).cast("long")
    n_lines = F.size(lines).cast("long")
    counted = base.select(
        *[F.col(f"k{i}") for i in range(len(keep))],
        n_words.alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _count(x, SYMBOLS).alias("n_symbols"),
        (n_lines - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        n_lines.alias("n_lines"),
        _count(x, "[A-Z]").alias("n_upper"),
        _count(x, "!").alias("n_exclamations"),
        F.size(F.array_intersect(F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)]), words))
        .cast("long")
        .alias("n_stop_words"),
        F.size(F.filter(lines, lambda s: F.ltrim(s).rlike("^[-*•]"))).cast("long").alias("n_bullets"),
        F.size(F.filter(lines, lambda s: F.rtrim(s).endswith("..."))).cast("long").alias("n_ellipses"),
    )
    col = F.col
    counted = counted.withColumns(
        {
            "mean_word_length": _ratio(col("word_chars"), col("n_words")),
            "symbols_per_word": _ratio(col("n_symbols"), col("n_words")),
            "upper_case_share": _ratio(col("n_upper"), col("word_chars")),
            "exclamations_per_word": _ratio(col("n_exclamations"), col("n_words")),
            "repeated_lines_share": _ratio(col("n_dup_lines"), col("n_lines")),
            "bullet_lines_share": _ratio(col("n_bullets"), col("n_lines")),
            "ellipsis_lines_share": _ratio(col("n_ellipses"), col("n_lines")),
        }
    )
    return counted


def broken_rule(rule: Rule) -> Column:
    value = F.col(rule.measure)
    low = value < F.lit(rule.low) if rule.low is not None else F.lit(False)
    high = value > F.lit(rule.high) if rule.high is not None else F.lit(False)
    return F.coalesce(low | high, F.lit(False))


def judged(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The columns `keep`, all measures, `base_failed`, `failed_rules` (names, in table order) and `kept`."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    failed = F.filter(
        F.array(*[F.when(broken_rule(r), F.lit(r.name)) for r in rules]), lambda name: name.isNotNull()
    )
    found = measured(df, text, keep).withColumns({"base_failed": base_failed, "failed_rules": failed})
    found = found.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    names = [c for c in found.columns if c not in {f"k{i}" for i in range(len(keep))}]
    return found.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], *names)
