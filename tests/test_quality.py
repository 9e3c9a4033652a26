import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import quality as q
from siltstone.sources.catalog import datasets

NOW = dt.datetime(2022, 6, 10, 12)


def result(check):
    row = check.first()
    return row.failing_rows, row.status


@pytest.fixture
def ids(spark):
    return spark.createDataFrame(
        [("a", 1.0), ("a", -1.0), ("b", None), (None, 0.0), (None, 2.0), ("c", 3.0), ("c", 4.0), ("c", 5.0)], "id string, v double"
    )


def test_unique_counts_repeated_values(ids):
    assert result(q.unique(ids, "u", "id")) == (2, "fail")
    assert result(q.unique(ids, "u", "id", "v")) == (0, "pass")


def test_not_null(ids):
    assert result(q.not_null(ids, "n", "id")) == (2, "fail")
    assert result(q.not_null(ids, "n", "id", "warn")) == (2, "warn")
    assert result(q.not_null(ids.where("id IS NOT NULL"), "n", "id")) == (0, "pass")


def test_expression_ignores_unknown(ids):
    assert result(q.expression_is_true(ids, "e", F.col("v") >= 0)) == (1, "fail")


def test_accepted_values(spark):
    df = spark.createDataFrame([("success",), ("odd",), ("odd",), (None,), ("strange",)], "s string")
    assert result(q.accepted_values(df, "a", "s", q.LAUNCH_STATUSES)) == (2, "fail")
    assert result(q.accepted_values(df.where("s = 'success'"), "a", "s", q.LAUNCH_STATUSES)) == (0, "pass")


def test_at_least_one(ids):
    assert result(q.at_least_one(ids, "o", "v")) == (0, "pass")
    assert result(q.at_least_one(ids.where("v IS NULL"), "o", "v")) == (1, "fail")
    assert result(q.at_least_one(ids.where("false"), "o", "v")) == (1, "fail")


def seen(spark, age):
    at = None if age is None else NOW - age
    return spark.createDataFrame([(at,), (NOW - dt.timedelta(days=30),) if at else (None,)], "at timestamp_ntz")


@pytest.mark.parametrize(
    "age, recent, fresh",
    [
        (dt.timedelta(hours=24), "pass", "pass"),
        (dt.timedelta(hours=24, microseconds=1), "fail", "warn"),
        (dt.timedelta(hours=48), "fail", "warn"),
        (dt.timedelta(hours=48, microseconds=1), "fail", "error"),
        (None, "pass", "error"),
    ],
)
def test_recency_and_freshness(spark, age, recent, fresh):
    df = seen(spark, age)
    assert q.recency(df, "r", "at", NOW).first().status == recent
    assert q.freshness(df, "f", "at", NOW).first().status == fresh


def test_same_day_check_agrees_with_the_pairs(spark):
    t = lambda h: dt.datetime(2022, 1, 1) + dt.timedelta(hours=h)
    launches = spark.createDataFrame([(i, t(h)) for i, h in enumerate([0, 5, 12, 23, 24, 30])] + [(99, None)], "id int, a timestamp_ntz")
    events = spark.createDataFrame([(t(h),) for h in [5, 12, 24, 47]] + [(None,)], "b timestamp_ntz")
    pairs = q.same_day_before(launches, events, "a", "b")
    assert sorted((r.id, r.b) for r in pairs.collect()) == [(0, t(5)), (0, t(12)), (1, t(12)), (4, t(47)), (5, t(47))]
    assert result(q.same_day_before_check(launches, events, "s", "a", "b")) == (4, "fail")
    assert result(q.same_day_before_check(launches.where("id = 3"), events, "s", "a", "b")) == (0, "pass")


def test_checks_union(ids):
    both = q.union_checks([q.not_null(ids, "x", "id"), q.unique(ids, "y", "v")])
    assert {r.check_name: r.status for r in both.collect()} == {"x": "fail", "y": "pass"}


LAUNCH = "id string, flight_number long, date_utc string, name string"


@pytest.mark.parametrize(
    "rows, columns, ok, errors, warnings",
    [
        ([], LAUNCH, False, ("no rows",), ()),
        ([("n",)], "name string", False, ("missing columns id, flight_number, date_utc",), ()),
        ([("1", None, "d", "n")], LAUNCH, False, ("missing columns flight_number",), ()),
        ([("1", 1, "d", "n"), (None, 2, "d", "n")], LAUNCH, True, (), ("1 null ids",)),
        ([("1", 1, "d", "n")], LAUNCH, True, (), ()),
    ],
)
def test_preflight(spark, rows, columns, ok, errors, warnings):
    verdict = q.preflight(spark.createDataFrame(rows, columns), datasets()["launches"])
    assert (verdict.ok, verdict.errors, verdict.warnings) == (ok, errors, warnings)


def test_preflight_of_events_and_datasets_without_contract(spark):
    events = spark.createDataFrame([("SEP-001", "2026-01-01T00:00:00Z", "SEP")], "activityID string, startTime string, eventType string")
    assert q.preflight(events, datasets()["solar_events"]).ok
    assert not q.preflight(events.drop("startTime"), datasets()["solar_events"]).ok
    assert q.preflight(events, datasets()["rockets"]).ok


def test_assertions(spark, ids):
    q.assert_has_columns(ids, ["id", "v"])
    q.assert_row_count(ids, 8)
    q.assert_no_nulls(ids.where("id IS NOT NULL"), "id")
    q.assert_column_type(ids, "id", str)
    q.assert_column_type(ids, "v", float)
    q.assert_column_type(ids, "v", T.DoubleType())
    q.assert_column_type(ids.selectExpr("v > 1 AS b", "cast(v AS int) AS i"), "b", bool)
    for call in (
        lambda: q.assert_has_columns(ids, ["id", "z"]),
        lambda: q.assert_row_count(ids, 7),
        lambda: q.assert_no_nulls(ids, "id"),
        lambda: q.assert_column_type(ids, "id", int),
        lambda: q.assert_column_type(ids, "z", int),
    ):
        with pytest.raises(AssertionError):
            call()
