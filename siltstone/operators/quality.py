"""Data quality checks.

A check is a one-row frame ``(check_name, failing_rows, status)``, so that any number of
them can be unioned, stored and gated on. Status is ``pass``, ``warn``, ``fail`` or
``error``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.exprs import ntz_literal
from siltstone.operators.interval import interval_join
from siltstone.sources.catalog import DatasetSpec

# Freshness limits of the raw tables.
WARN_AFTER = dt.timedelta(hours=24)
ERROR_AFTER = dt.timedelta(hours=48)
RECENT_WITHIN = dt.timedelta(days=1)
LAUNCH_STATUSES = ("success", "failure", "partial")


@dataclass(frozen=True)
class Measure:
    """A check that is one aggregate over a frame: its failing rows, or two limits."""

    name: str
    failing: Column
    on_failure: str = "fail"
    # a second aggregate: failing beyond it as well has this status
    beyond: Column | None = None
    on_beyond: str = "error"

    def _result(self) -> Column:
        failing = self.failing.cast("bigint")
        status = F.when(failing > 0, self.on_failure).otherwise("pass")
        if self.beyond is not None:
            status = F.when(self.beyond, self.on_beyond).otherwise(status)
        return F.struct(
            F.lit(self.name).alias("check_name"), failing.alias("failing_rows"), status.alias("status")
        )


def measure(df: DataFrame, *measures: Measure) -> DataFrame:
    """All the measures of a frame in one pass over it."""
    results = df.agg(F.array(*(m._result() for m in measures)).alias("results"))
    return results.select(F.explode("results").alias("r")).select("r.*")


def nulls_in(name: str, column: str, severity: str = "fail") -> Measure:
    return Measure(name, F.count_if(F.col(column).isNull()), severity)


def false_rows(name: str, condition: Column) -> Measure:
    """Rows for which the condition is false; unknown does not count."""
    return Measure(name, F.count_if(~condition))


def no_value(name: str, column: str) -> Measure:
    return Measure(name, F.when(F.count(column) == 0, 1).otherwise(0))


def newest_older_than(name: str, column: str, as_of: dt.datetime, within: dt.timedelta) -> Measure:
    """A column without any value passes, like every comparison with null here; use
    ``stale`` or ``no_value`` to catch that."""
    limit = ntz_literal(as_of - within)
    return Measure(name, F.when(F.max(column) < limit, 1).otherwise(0))


def stale(
    name: str,
    column: str,
    as_of: dt.datetime,
    warn_after: dt.timedelta = WARN_AFTER,
    error_after: dt.timedelta = ERROR_AFTER,
) -> Measure:
    """Age of the newest value against two limits; no value at all is an error."""
    warn = ntz_literal(as_of - warn_after)
    error = ntz_literal(as_of - error_after)
    newest = F.max(column)
    return Measure(
        name,
        F.when(newest >= warn, 0).otherwise(1),
        "warn",
        beyond=F.coalesce(newest < error, F.lit(True)),
    )


def unique(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Failing rows: key values that occur more than once; null keys are ignored."""
    present = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    repeated = (
        df.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    )
    return no_rows(repeated, name)


def not_null(df: DataFrame, name: str, column: str, severity: str = "fail") -> DataFrame:
    return measure(df, nulls_in(name, column, severity))


def expression_is_true(df: DataFrame, name: str, condition: Column) -> DataFrame:
    return measure(df, false_rows(name, condition))


def accepted_values(df: DataFrame, name: str, column: str, values: tuple[str, ...]) -> DataFrame:
    """Failing rows: distinct values outside the list; null is ignored."""
    outside = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return no_rows(outside.select(column).distinct(), name)


def at_least_one(df: DataFrame, name: str, column: str) -> DataFrame:
    """Fails when the column holds no value at all."""
    return measure(df, no_value(name, column))


def recency(
    df: DataFrame, name: str, column: str, as_of: dt.datetime, within: dt.timedelta = RECENT_WITHIN
) -> DataFrame:
    """Fails when the newest value is older than ``as_of - within``."""
    return measure(df, newest_older_than(name, column, as_of, within))


def freshness(
    df: DataFrame,
    name: str,
    column: str,
    as_of: dt.datetime,
    warn_after: dt.timedelta = WARN_AFTER,
    error_after: dt.timedelta = ERROR_AFTER,
) -> DataFrame:
    return measure(df, stale(name, column, as_of, warn_after, error_after))


def no_rows(failures: DataFrame, name: str) -> DataFrame:
    """A query for offending rows: any row is a failure."""
    return measure(failures, Measure(name, F.count(F.lit(1))))


def same_day_before(
    launches: DataFrame,
    events: DataFrame,
    launch_ts: str,
    event_ts: str,
    on: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Launches earlier than an event of the same day, one row per such event; ``on`` names
    pairs of columns that have to be equal besides.

    An event later on the same day is less than 24 hours away, so the interval join finds
    it, however many launches and events one day holds. For a gate use
    ``same_day_before_check``, which forms no pairs.
    """
    near = interval_join(
        launches, events, launch_ts, event_ts, dt.timedelta(0), dt.timedelta(hours=24), "inner", on=on
    )
    return near.where(
        (F.to_date(launch_ts) == F.to_date(event_ts)) & (F.col(launch_ts) < F.col(event_ts))
    )


def same_day_before_check(
    launches: DataFrame, events: DataFrame, name: str, launch_ts: str, event_ts: str
) -> DataFrame:
    """Gate on ``same_day_before``: failing rows are the launches that have such an event.

    A launch offends exactly if it is earlier than its day's last event, so one row per
    day replaces the pairs.
    """
    days = events.groupBy(F.to_date(event_ts).alias("_day")).agg(F.max(event_ts).alias("_last"))
    offending = (
        launches.withColumn("_day", F.to_date(launch_ts))
        .join(days, "_day")
        .where(F.col(launch_ts) < F.col("_last"))
    )
    return no_rows(offending, name)


def union_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


# -- checks of a batch before it is loaded ---------------------------------------------


@dataclass(frozen=True)
class Preflight:
    """Verdict on a batch: loaded unless ``errors``."""

    dataset: str
    rows: int
    errors: tuple[str, ...] = ()
    warnings: tuple[str, ...] = field(default=())

    @property
    def ok(self) -> bool:
        return not self.errors


def preflight_metrics(df: DataFrame, spec: DatasetSpec) -> list[Column]:
    """The counts the verdict needs besides the number of rows.

    With a declared schema every column exists; a key no record carries shows as a column
    without any value.
    """
    metrics = [F.count(f"`{c}`").alias(f"has_{c}") for c in spec.required if c in df.columns]
    if spec.id_column and spec.id_column in df.columns:
        metrics.append(F.count_if(F.col(spec.id_column).isNull()).alias("null_ids"))
    return metrics


def preflight_verdict(spec: DatasetSpec, counts: dict) -> Preflight:
    rows = counts.get("rows", 0)
    if not rows:
        return Preflight(spec.name, 0, ("no rows",))
    missing = [c for c in spec.required if not counts.get(f"has_{c}", 0)]
    errors = (f"missing columns {', '.join(missing)}",) if missing else ()
    nulls = counts.get("null_ids", 0)
    return Preflight(spec.name, rows, errors, (f"{nulls} null ids",) if nulls else ())


def preflight(df: DataFrame, spec: DatasetSpec) -> Preflight:
    """The same verdict on a frame by itself, in one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), *preflight_metrics(df, spec)).first()
    return preflight_verdict(spec, row.asDict())


# -- assertions -------------------------------------------------------------------------


def assert_has_columns(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise AssertionError(f"missing columns {missing}, present {df.columns}")


def assert_no_nulls(df: DataFrame, column: str) -> None:
    nulls = df.agg(F.count_if(F.col(f"`{column}`").isNull())).first()[0]
    if nulls:
        raise AssertionError(f"column {column!r} has {nulls} nulls")


def assert_column_type(df: DataFrame, column: str, expected: type | T.DataType) -> None:
    if column not in df.columns:
        raise AssertionError(f"column {column!r} does not exist")
    families = {
        str: (T.StringType,),
        int: (T.IntegerType, T.LongType),
        float: (T.FloatType, T.DoubleType),
        bool: (T.BooleanType,),
    }
    actual = df.schema[column].dataType
    good = isinstance(actual, families[expected]) if isinstance(expected, type) else actual == expected
    if not good:
        raise AssertionError(f"column {column!r} is {actual.simpleString()}, expected {expected}")


def assert_row_count(df: DataFrame, expected: int) -> None:
    actual = df.count()
    if actual != expected:
        raise AssertionError(f"expected {expected} rows, found {actual}")
