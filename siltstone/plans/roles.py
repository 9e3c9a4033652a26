"""The star-schema test tables in the roles of the raw datasets.

Everything is derived row by row (or by one combining grouping) from whole tables, so
the work of a query grows with them.

``shipments``: launches are line items, rockets suppliers, payloads parts, cores
customers, solar events orders. Launch ids repeat, payload lists may be null, empty or
name unknown payloads, masses may be null or zero.

``orders``: launches are orders, rockets the order priorities, payloads customers, cores
suppliers, solar events the days with shipments. Ids are unique.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.exprs import ntz_literal
from siltstone.functions.jsonx import encode_complex_columns

AS_OF = dt.datetime(2024, 2, 1, 6, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _iso_millis(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _iso_minutes(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm'Z'")


def _ingested(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_timestamp", ntz_literal(AS_OF))


# -- shipments --------------------------------------------------------------------------


def shipment_launches(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = _text("l_partkey"), _text("l_suppkey")
    payloads = (
        F.when(F.col("l_returnflag") == "N", F.format_string('["%s","%s"]', part, supplier))
        .when(F.col("l_returnflag") == "A", F.format_string('["%s","S%s"]', part, supplier))
        .when(F.col("l_linestatus") == "F", F.lit("[]"))
    )
    success = F.when(F.col("l_linestatus") == "F", "true").when(F.col("l_returnflag") != "N", "false")
    return _ingested(
        table(spark, sf_dir, "lineitem").select(
            F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("flight_number"),
            F.concat(F.lit("Shipment "), _text("l_orderkey")).alias("name"),
            _iso_millis("l_shipdate").alias("date_utc"),
            supplier.alias("rocket"),
            success.alias("success"),
            F.col("l_returnflag").alias("details"),
            payloads.alias("payloads"),
            F.to_json(F.array(F.struct(supplier.alias("core")))).alias("cores"),
            _text("l_linenumber").alias("launchpad"),
        )
    )


def supplier_rockets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(
        table(spark, sf_dir, "supplier").select(
            _text("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.concat(F.lit("N"), _text("s_nationkey")).alias("type"),
            F.when(F.col("s_acctbal") > 0, "on").otherwise("off").alias("active"),
            F.col("s_acctbal").alias("cost_per_launch"),
            (F.col("s_nationkey") + F.lit(0.5)).alias("success_rate_pct"),
            F.to_json(F.array(F.struct(F.lit("leo").alias("id"), F.col("s_acctbal").alias("kg")))).alias(
                "payload_weights"
            ),
        )
    )


def part_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    mass = (
        F.when(F.col("p_type") == "PROMO", F.lit(None).cast("double"))
        .when(F.col("p_type") == "ECONOMY", F.lit(0.0))
        .otherwise(F.col("p_retailprice"))
    )
    return _ingested(
        table(spark, sf_dir, "part").select(
            _text("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("type"),
            (F.col("p_size") > 25).alias("reused"),
            mass.alias("mass_kg"),
            F.col("p_brand").alias("orbit"),
            F.when(F.col("p_size") > 1, F.to_json(F.array("p_brand", "p_type")))
            .otherwise("[]")
            .alias("customers"),
        )
    )


def customer_cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(
        table(spark, sf_dir, "customer").select(
            _text("c_custkey").alias("id"),
            F.col("c_name").alias("serial"),
            F.col("c_mktsegment").alias("status"),
            F.col("c_nationkey").cast("long").alias("reuse_count"),
            (F.col("c_nationkey") + F.lit(0.5)).alias("rtls_landings"),
            (-F.col("c_nationkey") - F.lit(0.5)).alias("asds_landings"),
        )
    )


def order_solar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    analysis = F.struct(
        (F.col("o_totalprice") / 250).alias("speed"),
        F.col("o_orderstatus").alias("type"),
        F.lit(30).alias("halfAngle"),
        (F.col("o_orderstatus") == "F").alias("isMostAccurate"),
    )
    return _ingested(
        table(spark, sf_dir, "orders").select(
            _text("o_orderkey").alias("activityID"),
            F.col("o_orderpriority").alias("catalog"),
            _iso_minutes("o_orderdate").alias("startTime"),
            F.when(F.col("o_orderstatus") == "P", "[]")
            .otherwise(F.to_json(F.array(analysis)))
            .alias("cmeAnalyses"),
            F.col("o_orderpriority").alias("sourceLocation"),
            F.col("o_orderstatus").alias("note"),
        )
    )


# -- orders -----------------------------------------------------------------------------


def order_launch_records(
    spark: SparkSession, sf_dir: str, known: Callable[[DataFrame], DataFrame] = lambda orders: orders
) -> DataFrame:
    """The launches with lists as lists, as they are landed."""
    success = F.when(F.col("o_orderstatus") == "F", F.lit(True)).when(
        F.col("o_orderstatus") == "O", F.lit(False)
    )
    return _ingested(
        known(table(spark, sf_dir, "orders")).select(
            _text("o_orderkey").alias("id"),
            F.col("o_orderkey").alias("flight_number"),
            F.concat(F.lit("Order "), _text("o_orderkey")).alias("name"),
            _iso_millis("o_orderdate").alias("date_utc"),
            F.col("o_orderpriority").alias("rocket"),
            success.alias("success"),
            F.col("o_orderstatus").alias("details"),
            F.array(_text("o_custkey")).alias("payloads"),
            F.array().cast("array<string>").alias("cores"),
            F.col("o_orderpriority").alias("launchpad"),
        )
    )


def order_launches(
    spark: SparkSession, sf_dir: str, known: Callable[[DataFrame], DataFrame] = lambda orders: orders
) -> DataFrame:
    return encode_complex_columns(order_launch_records(spark, sf_dir, known))


def priority_rockets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(F.max("o_totalprice").cast("long").alias("cost"), F.count(F.lit(1)).alias("n"))
        .select(
            F.col("o_orderpriority").alias("id"),
            F.col("o_orderpriority").alias("name"),
            F.lit("priority").alias("type"),
            F.lit(True).alias("active"),
            F.col("cost").alias("cost_per_launch"),
            F.lit(50).cast("long").alias("success_rate_pct"),
            F.to_json(F.array(F.struct(F.col("n").alias("kg")))).alias("payload_weights"),
        )
    )


def customer_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(
        table(spark, sf_dir, "customer").select(
            _text("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("type"),
            (F.col("c_acctbal") < 0).alias("reused"),
            F.col("c_acctbal").alias("mass_kg"),
            F.col("c_mktsegment").alias("orbit"),
            F.to_json(F.array("c_name")).alias("customers"),
        )
    )


def supplier_cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("s_nationkey").cast("long")
    return _ingested(
        table(spark, sf_dir, "supplier").select(
            _text("s_suppkey").alias("id"),
            F.col("s_name").alias("serial"),
            F.lit("active").alias("status"),
            nation.alias("reuse_count"),
            nation.alias("rtls_landings"),
            nation.alias("asds_landings"),
        )
    )


def shipping_day_solar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per day with shipments; its speed is the day's largest price."""
    days = (
        table(spark, sf_dir, "lineitem").groupBy("l_shipdate").agg(F.max("l_extendedprice").alias("price"))
    )
    return _ingested(
        days.select(
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("activityID"),
            F.lit("shipping days").alias("catalog"),
            _iso_minutes("l_shipdate").alias("startTime"),
            F.to_json(
                F.array(
                    F.struct(
                        (F.col("price") / 100).alias("speed"),
                        F.lit("C").alias("type"),
                        F.lit(30).alias("halfAngle"),
                        F.lit(True).alias("isMostAccurate"),
                    )
                )
            ).alias("cmeAnalyses"),
            F.lit("N20E15").alias("sourceLocation"),
            F.date_format("l_shipdate", "EEEE").alias("note"),
        )
    )


ORDER_ROLES = {
    "launches": order_launches,
    "rockets": priority_rockets,
    "payloads": customer_payloads,
    "cores": supplier_cores,
    "solar_events": shipping_day_solar_events,
}


def land(
    spark: SparkSession,
    sf_dir: str,
    location: str,
    known: Callable[[DataFrame], DataFrame] = lambda orders: orders,
) -> None:
    """Write the ``orders`` roles as landed JSON Lines, lists as real JSON lists.

    ``known`` limits the launches to those a given day has seen.
    """
    shapes = {
        "payloads": "array<string>",
        "cores": "array<string>",
        "customers": "array<string>",
        "payload_weights": "array<struct<kg: double>>",
        "cmeAnalyses": "array<struct<speed: double, type: string, halfAngle: double, isMostAccurate: boolean>>",
    }

    def spread(orders: DataFrame) -> DataFrame:
        # a scan has no more tasks than its file has row groups, and encoding is most of the work;
        # ranges leave keys that lie together together, so what is loaded compresses nearly as well
        return known(orders.repartitionByRange("o_orderkey"))

    def write(name: str, role) -> None:
        df = order_launch_records(spark, sf_dir, spread) if name == "launches" else role(spark, sf_dir)
        parsed = {c: F.from_json(c, shapes[c]) for c, kind in df.dtypes if c in shapes and kind == "string"}
        df.drop("ingestion_timestamp").withColumns(parsed).write.json(f"{location}/{name}")

    # they do not depend on each other: one's last tasks leave cores to the next
    with ThreadPoolExecutor(max_workers=len(ORDER_ROLES)) as pool:
        list(pool.map(write, ORDER_ROLES.keys(), ORDER_ROLES.values()))
