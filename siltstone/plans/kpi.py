"""Business KPIs over the silver views. All are single groupings that combine first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.casts import to_decimal
from siltstone.functions.exprs import epoch_micros

MICROS_PER_DAY = 86_400_000_000


def success_rate_by_year(launches: DataFrame, at: str, success: Column | str) -> DataFrame:
    """Share of successful launches per year; unknown outcomes do not count."""
    flag = (F.col(success) if isinstance(success, str) else success).cast("int")
    return launches.groupBy(F.year(at).cast("bigint").alias("year")).agg(
        F.avg(flag).alias("success_rate"), F.count(flag).alias("launches")
    )


def density(launches: DataFrame, *by: str) -> DataFrame:
    """Number of launches per combination, e.g. rocket type and launch pad."""
    return launches.groupBy(*by).agg(F.count(F.lit(1)).alias("launches"))


def mean_days_between(failures: DataFrame, family: str, at: str) -> DataFrame:
    """Mean time between consecutive failures per family, in days.

    The gaps of a sorted series add up to last minus first, so no sorting is needed and a
    family of any size is one partial aggregate per task. Null below two failures.
    """
    u = epoch_micros(at)
    return (
        failures.where(F.col(at).isNotNull())
        .groupBy(family)
        .agg(
            F.count(F.lit(1)).alias("failures"),
            ((F.max(u) - F.min(u)) / F.nullif(F.count(F.lit(1)) - 1, F.lit(0)) / MICROS_PER_DAY).alias(
                "mean_days_between"
            ),
        )
    )


def status_summary(launches: DataFrame, status: str, mass: str) -> DataFrame:
    """Count and mean payload per status; the mean is over the exact decimal sum."""
    exact = to_decimal(mass)
    return launches.groupBy(status).agg(
        F.count(F.lit(1)).alias("total"),
        (F.sum(exact).cast("double") / F.nullif(F.count(exact), F.lit(0))).alias("avg_payload"),
    )
