"""Report queries on the layers. Results stay frames; only what is shown is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_ROWS = 5


def sample(df: DataFrame, *order: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows in a stated order, so the sample is repeatable."""
    return df.orderBy(*(F.asc_nulls_last(c) for c in order)).limit(rows)


def raw_launch_sample(raw: DataFrame) -> DataFrame:
    return sample(raw.select("id", "name", "success", "ingestion_timestamp"), "id")


def solar_sample(solar: DataFrame) -> DataFrame:
    return sample(solar, "event_at_utc", "activityid")


def rocket_overview(rockets: DataFrame) -> DataFrame:
    return rockets.select("rocket_name", "cost_per_launch_usd", "success_rate_pct")


def performance_sample(performance: DataFrame) -> DataFrame:
    return sample(performance, "launch_at_utc", "launch_id")


def cheapest(roi: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Lowest cost per kilogram; launches without a ratio come last."""
    return sample(roi, "usd_per_kg", "launch_id", rows=rows)


def under_solar_influence(weather: DataFrame) -> DataFrame:
    """Launches with an event, nearest first.

    The key breaks ties, which also lets the range sort split a run of equal distances.
    """
    hit = weather.where(F.col("solar_event_id").isNotNull())
    return hit.orderBy(F.asc_nulls_last("hours_diff"), F.asc_nulls_last("surrogate_key"))


def influence_message(weather: DataFrame) -> str:
    n = weather.where(F.col("solar_event_id").isNotNull()).count()
    if n == 0:
        return "no launch under solar influence in this period"
    return f"{n} launches under solar influence"


def time_coverage(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """First and last event time and row count, one row per source."""
    parts = [
        df.agg(
            F.min(at).alias("min_at"), F.max(at).alias("max_at"), F.count(F.lit(1)).alias("total_rows")
        ).select(F.lit(name).alias("source"), "min_at", "max_at", "total_rows")
        for name, (df, at) in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def ask(spark: SparkSession, sql: str) -> DataFrame:
    """Ad-hoc SQL over the registered ``<layer>_<name>`` views."""
    return spark.sql(sql)
