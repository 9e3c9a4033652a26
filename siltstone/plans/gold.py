"""Gold facts. ``processed_at`` comes in as a parameter, so reruns are repeatable."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.casts import to_ntz
from siltstone.functions.exprs import (
    MICROS_PER_HOUR,
    epoch_micros,
    month_of,
    pair_key,
    ratio_else_null,
    ratio_else_zero,
    risk_band,
    utc_literal,
    zero_if_null,
)
from siltstone.operators.interval import interval_aggregate, interval_join
from siltstone.operators.tables import PART
from siltstone.operators.unnest import element_sums, element_values

# The windows around a launch.
RISK_LOOKBACK = dt.timedelta(hours=24)
IMPACT_WINDOW = dt.timedelta(days=7)


def launch_measures(launches: DataFrame, payloads: DataFrame, solar: DataFrame) -> DataFrame:
    """Payload mass, and event count and top speed in the 24 hours up to a launch, per launch id.

    Masses of list elements and figures of launch times are tagged by their columns and meet in one
    grouping, which combines before its shuffle. What a launch has none of is null.
    """
    windows = interval_aggregate(
        launches,
        solar.select("activityid", "event_at_utc", "speed_km_s"),
        "launch_at_utc",
        "event_at_utc",
        before=RISK_LOOKBACK,
        after=dt.timedelta(0),
        aggregates={"_events": ("count", "activityid"), "_top_speed": ("max", "speed_km_s")},
    )
    risk = launches.select("launch_id", "launch_at_utc").join(windows, "launch_at_utc").drop("launch_at_utc")
    mass = element_values(launches, "payload_ids", ["launch_id"], payloads, "payload_id", "mass_kg", "inner")
    return (
        risk.unionByName(mass.withColumnRenamed("_value", "_mass"), allowMissingColumns=True)
        .groupBy("launch_id")
        .agg(
            F.sum("_mass").alias("total_payload_mass_kg"),
            F.sum("_events").alias("solar_events_count"),
            F.max("_top_speed").alias("max_solar_speed_km_s"),
        )
    )


def performance(
    launches: DataFrame, rockets: DataFrame, payloads: DataFrame, solar: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """One row per successful launch with a known rocket."""
    base = launches.where(F.col("is_success") == F.lit(True))
    measures = launch_measures(base, payloads, solar)
    return (
        base.select("launch_id", "launch_name", "launch_at_utc", "rocket_id")
        .join(rockets.select("rocket_id", "rocket_name", "cost_per_launch_usd"), "rocket_id")
        .join(measures, "launch_id", "left")
        .select(
            "launch_id",
            "launch_name",
            "launch_at_utc",
            "rocket_name",
            "cost_per_launch_usd",
            "total_payload_mass_kg",
            ratio_else_zero("cost_per_launch_usd", "total_payload_mass_kg").alias("usd_per_kg"),
            zero_if_null("solar_events_count").alias("count_cme_events"),
            zero_if_null("max_solar_speed_km_s").alias("peak_cme_speed"),
            risk_band("max_solar_speed_km_s").alias("mission_risk_profile"),
            utc_literal(as_of).alias("processed_at"),
        )
    )


def roi(raw_launches: DataFrame, rockets: DataFrame, payloads: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per launch with at least one known payload and a known rocket.

    Reads raw launches: failed ones count here. ``raw_launches`` may already carry
    ``launch_at_utc`` (the incremental run filters on it).
    """
    at = "launch_at_utc" if "launch_at_utc" in raw_launches.columns else to_ntz("date_utc")
    base = raw_launches.select(
        F.col("id").alias("launch_id"),
        F.col("rocket").alias("rocket_id"),
        (F.col(at) if isinstance(at, str) else at).alias("launch_at_utc"),
        "payloads",
    )
    metrics = element_sums(
        base,
        "payloads",
        ["launch_id", "rocket_id", "launch_at_utc"],
        payloads,
        "payload_id",
        "mass_kg",
        "total_payload_mass_kg",
        "inner",
    )
    return metrics.join(rockets.select("rocket_id", "rocket_name", "cost_per_launch_usd"), "rocket_id").select(
        "launch_id",
        "rocket_name",
        "total_payload_mass_kg",
        "cost_per_launch_usd",
        ratio_else_null("cost_per_launch_usd", "total_payload_mass_kg").alias("usd_per_kg"),
        "launch_at_utc",
        utc_literal(as_of).alias("processed_at"),
    )


def weather(launches: DataFrame, solar: DataFrame, as_of: dt.datetime, parted: bool = False) -> DataFrame:
    """One row per launch and event at most seven days apart, or one without event.

    What follows from one side's time alone is computed there: there are many more pairs. ``parted``
    rows carry the month they are stored in.
    """
    month = [month_of("launch_at_utc").alias(PART)] if parted else []
    pairs = interval_join(
        launches.select("launch_id", "launch_name", "launch_at_utc", "is_success", epoch_micros("launch_at_utc").alias("_launch_us"), *month),
        solar.select("activityid", "event_at_utc", "event_description", epoch_micros("event_at_utc").alias("_event_us")),
        "launch_at_utc",
        "event_at_utc",
        before=IMPACT_WINDOW,
        after=IMPACT_WINDOW,
        how="left",
    )
    return pairs.select(
        pair_key("launch_id", "activityid").alias("surrogate_key"),
        "launch_name",
        "launch_at_utc",
        "is_success",
        F.col("activityid").alias("solar_event_id"),
        F.col("event_at_utc").alias("solar_event_at"),
        (F.abs(F.col("_launch_us") - F.col("_event_us")) / F.lit(MICROS_PER_HOUR)).alias("hours_diff"),
        F.col("event_description").alias("nasa_note"),
        utc_literal(as_of).alias("processed_at"),
        *(PART for _ in month),
    )
