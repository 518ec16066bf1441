"""Lists kept in pages, so no group has to fit in one row or one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.session import stage

PAGE_SIZE = 1000


def page_of(position: Column, page_size: int = PAGE_SIZE) -> Column:
    return F.floor(position / page_size).cast("int")


def pages(
    df: DataFrame,
    group: list[str],
    elements: list[str],
    name: str,
    page_size: int = PAGE_SIZE,
    distinct: bool = False,
) -> DataFrame:
    """Elements per group as sorted arrays of `page_size` elements, the last one shorter; with `distinct` each value once.

    Page 0 has the first elements of the group's order, page 1 the next ones, whatever the partitioning. Equal elements
    are counted first. In groups that need several pages the place of an element is the number of elements before it:
    those in earlier ranges of the order, which are added up per range, and those before it in its own range. Where no group
    has more rows than a page, which a pass over the groups' columns tells, nothing of that is needed.
    """
    rows = df.select(*group, *elements)
    counted = rows.groupBy(*group, *elements).agg((F.lit(1) if distinct else F.count(F.lit(1))).cast("long").alias("_n"))
    most = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"]
    if (most or 0) <= page_size:
        return _lists(counted.withColumns({"page": F.lit(0), "_times": F.col("_n")}), group, elements, name)
    counted = stage(counted, "counted-elements")
    large = stage(
        counted.groupBy(*group).agg(F.sum("_n").alias("_all")).where(F.col("_all") > page_size).select(*group),
        "large-groups",
    )
    same = reduce(lambda a, b: a & b, [F.col(f"c.{g}").eqNullSafe(F.col(f"l.{g}")) for g in group])
    small = counted.alias("c").join(large.alias("l"), same, "left_anti").withColumns(
        {"page": F.lit(0), "_times": F.col("_n")}
    )
    paged = _paged(counted.alias("c").join(large.alias("l"), same, "left_semi"), group, elements, page_size)
    columns = [*group, *elements, "page", "_times"]
    return _lists(small.select(*columns).unionByName(paged.select(*columns)), group, elements, name)


def _lists(paged: DataFrame, group: list[str], elements: list[str], name: str) -> DataFrame:
    item = F.col(elements[0]) if len(elements) == 1 else F.struct(*elements)
    repeated = F.array_repeat(item, F.col("_times").cast("int"))
    return paged.groupBy(*group, "page").agg(F.array_sort(F.flatten(F.collect_list(repeated))).alias(name))


def _paged(counted: DataFrame, group: list[str], elements: list[str], page_size: int) -> DataFrame:
    """One row per element and page, with `_times`, the copies of the element on that page."""
    # The order of array_sort: a NULL element comes last, a NULL within a struct first.
    by_element = [F.col(e).asc_nulls_last() if len(elements) == 1 else F.col(e).asc() for e in elements]
    ranged = stage(
        counted.repartitionByRange(*group, *by_element).withColumn("_range", F.spark_partition_id()), "ranged-elements"
    )
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy(*group, "_range")
        .agg(F.sum("_n").alias("_in_range"))
        .select(*group, "_range", F.coalesce(F.sum("_in_range").over(before), F.lit(0)).alias("_shift"))
        .alias("s")
    )
    inside = Window.partitionBy(*group, "_range").orderBy(*by_element).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("r")
    keys = [*group, "_range"]
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    placed = local.join(shifts, same).select(
        *[F.col(f"r.{c}") for c in [*group, *elements, "_n"]], (F.col("r._local") + F.col("s._shift")).alias("_start")
    )
    end, page = F.col("_start") + F.col("_n"), F.col("page")
    first, last = page_of(F.col("_start"), page_size), page_of(end - 1, page_size)
    times = F.least(end, (page + 1).cast("long") * page_size) - F.greatest(F.col("_start"), page.cast("long") * page_size)
    return placed.withColumn("page", F.explode(F.sequence(first, last))).withColumn("_times", times)
