"""Routes of several providers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.functions.times import day_of_time
from tripspark.operators.lists import PAGE_SIZE, page_of
from tripspark.operators.ordering import number_in_groups
from tripspark.operators.skew import lookup_join
from tripspark.vocabulary import PROVIDERS

PAIR = ["origin", "destination"]
ROUTE_COLUMNS = ["route_id", "origin", "destination", "traveldate", "partner", "cost", "service_provider"]
CHUNK_IDS = 1_000_000  # route ids are unique per provider, so this many ids hold at most as many routes


def provider_rank(service_provider: Column) -> Column:
    ranks = F.create_map(*[F.lit(v) for pair in enumerate(PROVIDERS) for v in reversed(pair)])
    return F.coalesce(F.try_element_at(ranks, service_provider), F.lit(len(PROVIDERS)))


def provider_union(routes_by_provider: dict[str, DataFrame]) -> DataFrame:
    """Routes of all providers, with the provider's name and its place in an answer."""
    tagged = [
        routes.withColumn("service_provider", F.lit(provider)) for provider, routes in routes_by_provider.items()
    ]
    return with_rank(reduce(DataFrame.unionByName, tagged))


def with_rank(routes: DataFrame) -> DataFrame:
    return routes.select(*ROUTE_COLUMNS, provider_rank(F.col("service_provider")).alias("provider_rank"))


def routes_for_pair(routes: DataFrame, origin: int, destination: int) -> DataFrame:
    return routes.where((F.col("origin") == origin) & (F.col("destination") == destination))


def routes_by_pair(requests: DataFrame, routes: DataFrame) -> DataFrame:
    """Routes whose origin and destination some request asks for, each route once."""
    return lookup_join(routes, requests.select(*PAIR).distinct(), PAIR, "left_semi", check_size=True)


def routes_by_id(routes: DataFrame, service_provider: str, route_id: int) -> DataFrame:
    return routes.where((F.col("service_provider") == service_provider) & (F.col("route_id") == route_id))


def requests_with_routes(requests: DataFrame, routes: DataFrame) -> DataFrame:
    """Each request with every route of its pair, one row each; requests without routes stay.

    The output is as large as the lists of all requests together. For whole request tables use
    `trip_search`, which builds the list of a pair once and shares it.
    """
    return requests.join(routes, PAIR, "left")


def numbered_routes(routes: DataFrame) -> DataFrame:
    """Adds `row_no`, the place in the pair's list: by provider rank, then route id."""
    chunk = [F.col("provider_rank"), F.expr(f"route_id DIV {CHUNK_IDS}")]
    return number_in_groups(routes, PAIR, chunk, ["provider_rank", "route_id"])


def route_item() -> Column:
    return F.struct(
        "route_id", "origin", "destination", day_of_time(F.col("traveldate")).alias("date"), "partner", "cost",
        "service_provider",
    )


def route_pages(numbered: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Lists of routes per pair: `page`, and `routes` in order with at most `page_size` entries."""
    return (
        numbered.withColumn("page", page_of(F.col("row_no"), page_size))
        .groupBy(*PAIR, "page")
        .agg(F.array_sort(F.collect_list(F.struct("row_no", route_item().alias("route")))).alias("_items"))
        .select(*PAIR, "page", F.col("_items.route").alias("routes"))
    )
