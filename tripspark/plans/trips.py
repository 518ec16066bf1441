"""Trip search over tables of requests.

An answer depends on origin and destination only. So it is built once per distinct pair, and requests refer to it
by their pair: the work grows with requests plus routes, not with their product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.functions.text import booking_link
from tripspark.functions.times import day_of_time, time_text
from tripspark.operators.cities import city_pair_distance
from tripspark.operators.lists import PAGE_SIZE, page_of
from tripspark.operators.routes import PAIR, numbered_routes, provider_rank, route_item, with_rank
from tripspark.operators.skew import lookup_join
from tripspark.session import stage
from tripspark.sources.pairroutes import PairRoutes


def asked_pairs(requests: DataFrame, cities: DataFrame) -> DataFrame:
    """Distinct pairs with their number of requests, `km`, `distance` and `status`; stored, as they are read often."""
    pairs = requests.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("requests"))
    return stage(city_pair_distance(pairs, cities), "asked-pairs")


def answer_routes(pairs: DataFrame, routes: DataFrame | PairRoutes) -> DataFrame:
    """Routes of the pairs that have status 'ok', numbered from 0 within the pair, with the pair's columns.

    Numbering reads its rows twice, so the routes that someone asks for are stored first.
    """
    valid = pairs.where(F.col("status") == "ok")
    if isinstance(routes, PairRoutes):
        met = routes.of_pairs(valid).withColumn("provider_rank", provider_rank(F.col("service_provider")))
    else:
        met = lookup_join(with_rank(routes), valid, PAIR, "inner", check_size=True)
    return numbered_routes(stage(met, "asked-routes"))


def trip_search(
    requests: DataFrame, cities: DataFrame, routes: DataFrame | PairRoutes, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Answers: one row per asked pair and page of its route list.

    Columns: origin, destination, requests (how many ask for the pair), status, distance, page, routes. Every pair has
    page 0, with an empty list when there is no route or the status is 'error'. `with_request` gives the answers of
    single requests.
    """
    pairs = asked_pairs(requests, cities)
    facts = ["requests", "status", "distance"]
    entries = answer_routes(pairs, routes).select(
        *PAIR,
        *facts,
        page_of(F.col("row_no"), page_size).alias("page"),
        F.struct("row_no", route_item().alias("route")).alias("_item"),
    )
    heads = pairs.select(*PAIR, *facts, F.lit(0).alias("page"), F.lit(None).cast(entries.schema["_item"].dataType).alias("_item"))
    return (
        entries.unionByName(heads)
        .groupBy(F.col("origin"), F.col("destination"), F.col("page"))
        .agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in facts],
            F.array_sort(F.collect_list("_item")).alias("_items"),
        )
        .select(*PAIR, *facts, "page", F.col("_items.route").alias("routes"))
    )


def with_request(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers of the given requests: one row per request and page. Meant for requests someone looks at."""
    named = requests.select("request_id", F.struct(*PAIR).alias("_pair"))
    pages = answers.withColumn("_pair", F.struct(*PAIR))
    return named.join(pages, "_pair").select("request_id", "status", "distance", "page", "routes")


def trip_rows(requests: DataFrame, cities: DataFrame, routes: DataFrame) -> DataFrame:
    """The lists of `trip_search` as numbered rows with date text and booking link."""
    return answer_routes(asked_pairs(requests, cities), routes).select(
        *PAIR,
        "distance",
        "row_no",
        "service_provider",
        "route_id",
        day_of_time(F.col("traveldate")).alias("date"),
        time_text(F.col("traveldate")).alias("date_text"),
        "partner",
        "cost",
        booking_link(F.col("service_provider"), F.col("route_id")).alias("link"),
    )


def request_answers(requests: DataFrame, cities: DataFrame, routes: DataFrame) -> DataFrame:
    """One row per request: status, distance and the length of its route list."""
    lengths = routes.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("_routes"))
    answered = lookup_join(city_pair_distance(requests, cities), lengths, PAIR, "left", keys_from=requests)
    found = F.coalesce(F.when(F.col("status") == "ok", F.col("_routes")), F.lit(0))
    return answered.select("request_id", *PAIR, "status", "distance", found.alias("route_count"))
