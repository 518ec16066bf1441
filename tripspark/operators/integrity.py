"""Checks of keys, references and values. Each returns the violating rows with a `rule` column."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.operators.skew import lookup_join
from tripspark.vocabulary import PROVIDERS


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by several rows, with their `rows`; a key with a NULL part is never a duplicate."""
    whole = df.where(~_any([F.col(k).isNull() for k in keys]))
    return whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def check_unique(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    return duplicate_keys(df, keys).withColumn("rule", F.lit(rule))


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str, rule: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key passes."""
    known = parent.select(F.col(parent_column).alias(column))
    orphans = lookup_join(child.where(F.col(column).isNotNull()), known, [column], "left_anti", check_size=True)
    return orphans.select(*child.columns, F.lit(rule).alias("rule"))


def check_booking_orphans(booked: DataFrame, routes: DataFrame, rule: str) -> DataFrame:
    """Bookings whose route does not exist at their provider."""
    names = F.create_map(*[F.lit(v) for pair in PROVIDERS.items() for v in pair])
    known = routes.select(F.try_element_at(names, "service_provider").alias("service_provider"), "route_id")
    orphans = lookup_join(booked, known, ["service_provider", "route_id"], "left_anti")
    return orphans.select(*booked.columns, F.lit(rule).alias("rule"))


def check_domain(df: DataFrame, column: str, domain: list[str], rule: str) -> DataFrame:
    """NULL passes."""
    return df.where(~F.col(column).isin(*domain)).withColumn("rule", F.lit(rule))


def check_not_null(df: DataFrame, columns: list[str], rule: str) -> DataFrame:
    return df.where(_any([F.col(c).isNull() for c in columns])).withColumn("rule", F.lit(rule))


def check_length(df: DataFrame, column: str, longest: int, rule: str) -> DataFrame:
    return df.where(F.length(column) > longest).withColumn("rule", F.lit(rule))


def check_value_size(df: DataFrame, column: str, size: int, rule: str) -> DataFrame:
    """Values of `size` bytes or more."""
    return df.where(F.octet_length(column) >= size).withColumn("rule", F.lit(rule))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, in one pass: one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "nulls")


def count_broken(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations of row rules, all in one pass: one row per rule."""
    counts = df.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
    return counts.unpivot([], [F.col(f"`{rule}`") for rule in rules], "rule", "violations")


def count_violations(violations: DataFrame, rule: str) -> DataFrame:
    """One row, also without violations."""
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


# All rules in one pass


@dataclass
class TableRules:
    """What is checked on one table: keys that must be unique, references, keys that others refer to, and row rules.

    Keys are lists of columns or expressions; `parents` names the references of other tables.
    """

    rows: DataFrame
    keys: dict[str, list[Column | str]] = field(default_factory=dict)
    children: dict[str, list[Column | str]] = field(default_factory=dict)
    parents: dict[str, list[Column | str]] = field(default_factory=dict)
    broken: dict[str, Column] = field(default_factory=dict)


def _key_text(key: list[Column | str]) -> Column:
    """Different texts for different keys, NULL where a part is missing."""
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in key]
    return F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]) if len(parts) > 1 else parts[0]


def _entries(table: TableRules) -> DataFrame:
    """Rows (rule, key, n, known): each row of the table once for each rule that it matters for."""

    def entry(rule: str, key: Column, n: int, known: bool) -> Column:
        told = F.struct(
            F.lit(rule).alias("rule"), key.alias("key"), F.lit(n).cast("bigint").alias("n"), F.lit(known).alias("known")
        )
        return F.when(key.isNotNull(), told)

    told = [
        *[entry(rule, _key_text(key), 1, False) for rule, key in (table.keys | table.children).items()],
        *[entry(rule, _key_text(key), 0, True) for rule, key in table.parents.items()],
        *[entry(rule, F.when(broken, F.lit("")), 1, False) for rule, broken in table.broken.items()],
    ]
    return table.rows.select(F.explode(F.array_compact(F.array(*told))).alias("e")).select("e.*")


def violations(tables: list[TableRules]) -> DataFrame:
    """Violations per rule, also where there are none: keys held by several rows, rows without parent, rows that break a rule.

    Every table is read once. What matters for keys and references meets in one shuffle by rule and key, summed up per task
    before, so a key that very many rows have is no hot key. NULL parts make a key or reference pass.
    """
    spark = tables[0].rows.sparkSession
    unique = [rule for t in tables for rule in t.keys]
    rules = [rule for t in tables for rule in (*t.keys, *t.children, *t.broken)]
    met = (
        reduce(DataFrame.unionByName, [_entries(t) for t in tables])
        .groupBy("rule", "key")
        .agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    )
    count = F.when(F.col("rule").isin(unique), (F.col("n") > 1).cast("bigint")).otherwise(
        F.when(F.col("known"), F.lit(0)).otherwise(F.col("n"))
    )
    none = spark.createDataFrame([(rule, 0) for rule in rules], "rule string, violations long")
    found = met.select("rule", count.alias("violations"))
    return found.unionByName(none).groupBy("rule").agg(F.sum("violations").alias("violations"))
