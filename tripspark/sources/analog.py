"""Trip and trace tables derived from the order and event tables, row for row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripspark.functions.times import micros_of_time
from tripspark.operators.ordering import previous_in_group
from tripspark.session import stage


class AnalogTables:
    """Reads `folder`/<table>.parquet; every method returns a lazy view of whole tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> DataFrame:
        """Reads the schema from the files once per table."""
        reader = self.spark.read.schema(self._schemas[name]) if name in self._schemas else self.spark.read
        stored = reader.parquet(f"{self.folder}/{name}.parquet")
        self._schemas[name] = stored.schema
        return stored

    def cities(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            key.alias("city_id"),
            F.col("n_name").alias("city_name"),
            ((key * 37) % 140 - 70).cast("double").alias("latitude"),
            ((key * 73) % 360 - 180).cast("double").alias("longitude"),
        )

    def routes(self) -> DataFrame:
        """One route per provider and id: the key of the line items is not unique.

        Orders get their city first. Line items are dealt by order last, to meet it, and lie right for being grouped then.
        """
        lines = self.table("lineitem").select(
            "l_linestatus", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice"
        )
        suppliers = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        customers = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        ends = (
            self.table("orders")
            .select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
            .join(customers, "o_custkey")
            .groupBy("l_orderkey")
            .agg(F.min("c_nationkey").alias("destination"))
        )
        provider = F.when(F.col("l_linestatus") == "O", "drive-now").otherwise("deutsche-bahn")
        return (
            lines.join(suppliers, "l_suppkey")
            .join(parts, "l_partkey", "left")
            .join(ends, "l_orderkey")
            .groupBy("l_orderkey", "l_linenumber", "l_linestatus")  # a number first makes sorting cheap
            .agg(
                F.min("s_nationkey").alias("origin"),
                F.min("destination").alias("destination"),
                F.min("l_shipdate").alias("traveldate"),
                F.min("p_brand").alias("partner"),
                F.min("l_extendedprice").alias("_price"),
            )
            .select(
                provider.alias("service_provider"),
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("route_id"),
                "origin",
                "destination",
                "traveldate",
                "partner",
                F.floor(F.col("_price") / 100).cast("int").alias("cost"),
            )
        )

    def stored_routes(self) -> DataFrame:
        """Routes written once, for queries that read them several times."""
        return stage(self.routes(), "routes")

    def trip_requests(self) -> DataFrame:
        """Every 40th request names the unknown city 99."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("request_id"),
            F.col("c_nationkey").alias("origin"),
            F.when(key % 40 == 0, 99).otherwise((key * 7) % 25).cast("int").alias("destination"),
        )

    def booking_requests(self, *more: Column) -> DataFrame:
        """One request per order; `more` are further columns of the order."""
        priority = F.col("o_orderpriority")
        service = (
            F.when(priority.startswith("1"), "drive-now")
            .when(priority.startswith("2"), "deutsche-bahn")
            .otherwise("other")
        )
        return self.table("orders").select(
            F.col("o_orderkey").alias("request_id"),
            service.alias("service"),
            (F.col("o_orderkey") * 10 + 1).alias("route_id"),
            *more,
        )

    def spans(self, parents: bool = True) -> DataFrame:
        """One span per event. Without `parents`, which need the order of each trace, `parent_id` is NULL."""
        events = self.table("events").select("user_id", "event_id", "event_type", "ts", "value")
        if parents:
            events = previous_in_group(
                events, ["user_id"], ["ts", "event_id"], "event_id", "parent_id", F.date_trunc("minute", "ts")
            )
        else:
            events = events.withColumn("parent_id", F.lit(None).cast("bigint"))
        return events.select(
            F.lit(0).cast("bigint").alias("trace_id_high"),
            F.col("user_id").alias("trace_id"),
            F.col("event_id").alias("id"),
            F.col("event_type").alias("name"),
            "parent_id",
            micros_of_time(F.col("ts")).alias("start_ts"),
            F.floor(F.col("value") * 1000).cast("bigint").alias("duration"),
            (F.col("event_id") % 3 == 0).alias("scanned"),
        )

    def annotations(self) -> DataFrame:
        """Nine of ten events carry one annotation. Addresses and ports are not in the data."""

        def missing(kind: str) -> Column:
            return F.lit(None).cast(kind)

        key = F.col("event_id")
        layer = F.when(key % 7 < 4, "-mobility-service").otherwise("-core-service")
        return (
            self.table("events")
            .where(key % 10 != 0)
            .select(
                F.lit(0).cast("bigint").alias("trace_id_high"),
                F.col("user_id").alias("trace_id"),
                key.alias("span_id"),
                F.lit("k").alias("a_key"),
                F.get_json_object("props", "$.k").alias("a_value"),
                F.lit(6).alias("a_type"),
                micros_of_time(F.col("ts")).alias("a_timestamp"),
                missing("int").alias("endpoint_ipv4"),
                missing("binary").alias("endpoint_ipv6"),
                missing("int").alias("endpoint_port"),
                F.concat(F.lit("svc-"), (key % 7).cast("string"), layer).alias("endpoint_service_name"),
                F.lit(False).alias("scanned"),
            )
        )

    def varied_spans(self) -> DataFrame:
        """Spans with both halves of the trace id and, on some, no start."""
        return self.table("events").select(
            (F.col("user_id") % 2).cast("bigint").alias("trace_id_high"),
            F.col("user_id").alias("trace_id"),
            F.col("event_id").alias("id"),
            F.col("event_type").alias("name"),
            F.lit(None).cast("bigint").alias("parent_id"),
            F.when(F.col("event_id") % 13 != 0, micros_of_time(F.col("ts"))).alias("start_ts"),
            F.floor(F.col("value") * 1000).cast("bigint").alias("duration"),
            (F.col("event_id") % 3 == 0).alias("scanned"),
        )

    def varied_annotations(self) -> DataFrame:
        """One to three annotations per event: tags and events, equal and missing times, ports above 32,767."""
        key, i = F.col("event_id"), F.col("i")
        time = micros_of_time(F.date_trunc("minute", "ts"))
        return (
            self.table("events")
            .select("*", F.explode(F.sequence(F.lit(0), (key % 3).cast("int"))).alias("i"))
            .select(
                (F.col("user_id") % 2).cast("bigint").alias("trace_id_high"),
                F.col("user_id").alias("trace_id"),
                key.alias("span_id"),
                F.element_at(F.array(F.lit("http"), F.lit("k"), F.lit("sr")), i + 1).alias("a_key"),
                F.concat_ws("-", "event_type", i.cast("string")).alias("a_value"),
                F.when(i == 2, -1).otherwise(6).alias("a_type"),
                F.when(~((i == 1) & (key % 11 == 0)), time).alias("a_timestamp"),
                (key % 1000).cast("int").alias("endpoint_ipv4"),
                F.lit(None).cast("binary").alias("endpoint_ipv6"),
                F.when(i == 0, -15536).otherwise(8080).alias("endpoint_port"),
                F.concat(F.lit("svc-"), (key % 7).cast("string")).alias("endpoint_service_name"),
                (key % 4 == 0).alias("scanned"),
            )
        )

    def users(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_name").alias("username"), (F.col("c_acctbal") >= 0).alias("enabled")
        )

    def user_roles(self) -> DataFrame:
        customers = self.table("customer")
        segment = customers.where(F.col("c_custkey") % 10 != 0).select(
            F.col("c_name").alias("username"), F.concat(F.lit("ROLE_"), "c_mktsegment").alias("role")
        )
        admins = customers.where(F.col("c_nationkey") < 5).select(
            F.col("c_name").alias("username"), F.lit("ROLE_ADMIN").alias("role")
        )
        return segment.unionByName(admins)
