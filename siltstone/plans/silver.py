"""Silver views: renamed, typed, JSON keys pulled out. One function per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.casts import to_bool, to_decimal, to_int, to_ntz, to_text
from siltstone.functions.jsonx import first_element, first_fields


def launches(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("launch_id"),
        "flight_number",
        F.col("name").alias("launch_name"),
        to_ntz("date_utc").alias("launch_at_utc"),
        F.col("rocket").alias("rocket_id"),
        to_bool("success").alias("is_success"),
        "details",
        F.col("payloads").alias("payload_ids"),
        F.col("cores").alias("core_details"),
        F.col("ingestion_timestamp").alias("ingested_at"),
    )


def rockets(raw: DataFrame) -> DataFrame:
    weighed = first_fields(raw, "payload_weights", _kg="kg")
    return weighed.select(
        F.col("id").alias("rocket_id"),
        F.col("name").alias("rocket_name"),
        F.col("type").alias("rocket_type"),
        to_bool("active").alias("is_active"),
        to_decimal("cost_per_launch").alias("cost_per_launch_usd"),
        to_int("success_rate_pct").alias("success_rate_pct"),
        to_decimal("_kg").alias("max_payload_kg_leo"),
        F.col("ingestion_timestamp").alias("ingested_at"),
    )


def payloads(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("payload_id"),
        F.col("name").alias("payload_name"),
        F.col("type").alias("payload_type"),
        to_bool("reused").alias("is_payload_reused"),
        to_decimal("mass_kg").alias("mass_kg"),
        F.col("orbit").alias("orbit_code"),
        to_text(first_element("customers")).alias("primary_customer"),
        F.col("ingestion_timestamp").alias("ingested_at"),
    )


def cores(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("core_id"),
        F.col("serial").alias("core_serial"),
        F.col("status").alias("core_status"),
        to_int("reuse_count").alias("reuse_count"),
        to_int("rtls_landings").alias("land_landings"),
        to_int("asds_landings").alias("sea_landings"),
        F.col("ingestion_timestamp").alias("ingested_at"),
    )


def solar_events(raw: DataFrame) -> DataFrame:
    """Only the first analysis of an event counts; events without a speed are dropped."""
    analysed = first_fields(
        raw, "cmeAnalyses", _speed="speed", _type="type", _half_angle="halfAngle", _accurate="isMostAccurate"
    )
    return analysed.where(F.col("_speed").isNotNull()).select(
        F.col("activityID").alias("activityid"),
        F.col("catalog").alias("catalog_source"),
        to_ntz("startTime").alias("event_at_utc"),
        to_decimal("_speed").alias("speed_km_s"),
        to_text("_type").alias("cme_type"),
        to_decimal("_half_angle").alias("half_angle"),
        to_bool("_accurate").alias("is_most_accurate"),
        F.col("sourceLocation").alias("source_location"),
        F.col("note").alias("event_description"),
        F.col("ingestion_timestamp").alias("ingested_at"),
    )
