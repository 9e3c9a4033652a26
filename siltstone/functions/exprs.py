"""Scalar expressions of the marts and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the performance and weather marts.
HIGH_RISK_ABOVE = 1000
MEDIUM_RISK_ABOVE = 500
NO_EVENT = "NO_EVENT"
LOOKBACK_DAYS = 60

MICROS_PER_HOUR = 3.6e9

# Null placeholder of the usual hashed surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ratio(cost: Column | str, mass: Column | str) -> Column:
    return _col(cost).cast("double") / _col(mass).cast("double")


def ratio_else_zero(cost: Column | str, mass: Column | str) -> Column:
    return F.when(_col(mass) > 0, _ratio(cost, mass)).otherwise(F.lit(0.0))


def ratio_else_null(cost: Column | str, mass: Column | str) -> Column:
    return F.when(_col(mass) > 0, _ratio(cost, mass))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def risk_band(speed: Column | str) -> Column:
    """Strict thresholds; no speed at all is low risk."""
    c = _col(speed)
    return (
        F.when(c > HIGH_RISK_ABOVE, "HIGH RISK")
        .when(c > MEDIUM_RISK_ABOVE, "MEDIUM RISK")
        .otherwise("LOW RISK")
    )


def pair_key(left_id: Column | str, right_id: Column | str) -> Column:
    """``left-right`` with a placeholder for a missing right id; null left gives null."""
    return F.concat(
        _col(left_id).cast("string"),
        F.lit("-"),
        F.coalesce(_col(right_id).cast("string"), F.lit(NO_EVENT)),
    )


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 over the column values as text."""
    texts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def ntz_literal(at: dt.datetime | None) -> Column:
    """A time without zone as a literal. Built from text: a datetime object would pass
    through the zone of the driver's operating system."""
    return F.lit(None if at is None else at.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_literal(at: dt.datetime) -> Column:
    """The instant of a time that is meant as UTC, whatever the driver's zone."""
    return F.lit(at.isoformat(sep=" ") + "+00:00").cast("timestamp")


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, negative before that."""
    return F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(ts)
    )


def hours_between(a: Column | str, b: Column | str) -> Column:
    """Absolute distance of two timestamps in hours."""
    return F.abs(F.timestamp_diff("MICROSECOND", _col(b), _col(a))) / F.lit(MICROS_PER_HOUR)


def month_of(ts: Column | str) -> Column:
    """``yyyy-MM`` of a timestamp; rows without one share the part ``none``."""
    return F.coalesce(F.date_format(_col(ts), "yyyy-MM"), F.lit("none"))


def lookback_window(target: dt.date, days: int = LOOKBACK_DAYS) -> tuple[str, str]:
    """Both ends of the request window, as ISO days."""
    return (target - dt.timedelta(days=days)).isoformat(), target.isoformat()


def within_days(day: Column | str, start: str, end: str) -> Column:
    """Timestamps whose day lies in the closed window [start, end].

    Written on the bare column, so that the scan can skip row groups.
    """
    c = _col(day)
    upper = (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(upper).cast("timestamp_ntz"))
