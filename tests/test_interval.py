import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators.interval import interval_aggregate, interval_join
from tests.conftest import plan_of

EPOCH = dt.datetime(1970, 1, 1)
L = "lid long, lts timestamp_ntz"
R = "rid long, rts timestamp_ntz, speed double"


def micros(n):
    return dt.timedelta(microseconds=n)


def brute(left, right, before, after, how):
    out = []
    for lid, lts in left:
        hits = [
            (rid, rts, v)
            for rid, rts, v in right
            if lts is not None and rts is not None and lts - before <= rts <= lts + after
        ]
        out += [(lid, lts, *h) for h in hits]
        if how == "left" and not hits:
            out.append((lid, lts, None, None, None))
    return Counter(out)


def sample(seed, n, m, spread, step):
    """Random times around 1970 on a coarse grid, so that bounds are often met exactly."""
    rnd = random.Random(seed)
    moment = lambda: EPOCH + step * rnd.randint(-spread, spread)
    left = [(rnd.randint(0, n // 2), None if rnd.random() < 0.05 else moment()) for _ in range(n)]
    right = [(rnd.randint(0, m // 2), None if rnd.random() < 0.05 else moment(), 1.0 * (i % 7)) for i in range(m)]
    # full copies on both sides
    return left + left[: n // 4], right + right[: m // 4]


CASES = [
    # before, after, step of the time grid
    (dt.timedelta(hours=24), dt.timedelta(0), dt.timedelta(hours=6)),
    (dt.timedelta(days=7), dt.timedelta(days=7), dt.timedelta(days=1)),
    (dt.timedelta(0), dt.timedelta(0), micros(1)),
    (micros(1), micros(2), micros(1)),
    (dt.timedelta(0), dt.timedelta(hours=3), dt.timedelta(minutes=45)),
    (dt.timedelta(minutes=7, microseconds=13), dt.timedelta(seconds=5), dt.timedelta(minutes=1)),
]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("case", range(len(CASES)))
def test_pairs_equal_the_direct_join(spark, case, how):
    before, after, step = CASES[case]
    left, right = sample(case, 60, 50, 40, step)
    for block_rows in (4096, 3):
        got = interval_join(
            spark.createDataFrame(left, L),
            spark.createDataFrame(right, R),
            "lts",
            "rts",
            before,
            after,
            how,
            block_rows,
        )
        assert Counter(tuple(r) for r in got.collect()) == brute(left, right, before, after, how)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("block_rows", [4096, 3])
def test_keys_of_both_sides_have_to_be_equal(spark, how, block_rows):
    """Ids serve as keys: a few of them, one on most rows, some null."""
    before, after, step = CASES[1]
    key = lambda n: None if n % 11 == 0 else (0 if n % 3 else n % 5)
    left, right = ([(key(r[0]), *r[1:]) for r in rows] for rows in sample(9, 60, 50, 20, step))
    got = interval_join(
        spark.createDataFrame(left, L),
        spark.createDataFrame(right, R),
        "lts",
        "rts",
        before,
        after,
        how,
        block_rows,
        on=[("lid", "rid")],
    )
    want = Counter()
    for row in left:
        want += brute([row], [r for r in right if r[0] is not None and r[0] == row[0]], before, after, how)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_bounds_are_inclusive_to_the_microsecond(spark):
    at = dt.datetime(2022, 5, 1, 12)
    day = dt.timedelta(days=1)
    times = [at - day - micros(1), at - day, at, at + micros(1)]
    right = [(i, t, 1.0) for i, t in enumerate(times)]
    got = interval_join(
        spark.createDataFrame([(1, at)], L), spark.createDataFrame(right, R), "lts", "rts", day, dt.timedelta(0)
    )
    assert sorted(r.rid for r in got.collect()) == [1, 2]


def test_a_hot_instant_is_spread_over_blocks(spark):
    """A third of each side at one instant: all pairs come out, from many join keys."""
    at = dt.datetime(2022, 5, 1)
    left = [(i, at if i % 3 == 0 else at + dt.timedelta(days=i)) for i in range(90)]
    right = [(i, at if i % 3 == 0 else at + dt.timedelta(days=100 + i), 1.0) for i in range(90)]
    hour = dt.timedelta(hours=1)
    got = interval_join(
        spark.createDataFrame(left, L), spark.createDataFrame(right, R), "lts", "rts", hour, hour, "inner", 4
    )
    assert Counter(tuple(r) for r in got.collect()) == brute(left, right, hour, hour, "inner")
    assert got.count() >= 900


@pytest.mark.parametrize("sides", [(0, 5), (5, 0), (0, 0)])
def test_empty_sides(spark, sides):
    left, right = sample(1, 40, 40, 5, dt.timedelta(hours=1))
    left, right = left[: sides[0]], right[: sides[1]]
    day = dt.timedelta(days=1)
    for how in ("left", "inner"):
        got = interval_join(
            spark.createDataFrame(left, L), spark.createDataFrame(right, R), "lts", "rts", day, day, how
        )
        assert Counter(tuple(r) for r in got.collect()) == brute(left, right, day, day, how)


def test_arguments_are_checked(spark):
    left = spark.createDataFrame([], L)
    day = dt.timedelta(days=1)
    with pytest.raises(ValueError, match="unsupported"):
        interval_join(left, spark.createDataFrame([], R), "lts", "rts", day, day, "full")
    with pytest.raises(ValueError, match="both sides"):
        interval_join(left, left, "lts", "lts", day, day)


def test_other_time_zones_are_refused(spark):
    left, right = spark.createDataFrame([], L), spark.createDataFrame([], R)
    day = dt.timedelta(days=1)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            interval_join(left, right, "lts", "rts", day, day)
        with pytest.raises(ValueError, match="UTC"):
            interval_aggregate(left, right, "lts", "rts", day, day, {"n": ("count", "rid")})
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("case", range(len(CASES)))
def test_aggregates_equal_the_direct_join(spark, case):
    before, after, step = CASES[case]
    left, right = sample(case + 100, 60, 50, 40, step)
    got = interval_aggregate(
        spark.createDataFrame(left, L),
        spark.createDataFrame(right, R),
        "lts",
        "rts",
        before,
        after,
        {"n": ("count", "rid"), "top": ("max", "speed"), "low": ("min", "speed"), "total": ("sum", "speed")},
    )
    want = {}
    for lts in {t for _, t in left if t is not None}:
        values = [v for _, t, v in right if t is not None and lts - before <= t <= lts + after]
        if values:
            want[lts] = (len(values), max(values), min(values), sum(values))
    assert {r.lts: (r.n, r.top, r.low, r.total) for r in got.collect()} == want


def test_aggregate_counts_values_not_rows(spark):
    at = dt.datetime(2022, 5, 1)
    got = interval_aggregate(
        spark.createDataFrame([(1, at)], L),
        spark.createDataFrame([(None, at, None), (2, at, 5.0)], R),
        "lts",
        "rts",
        dt.timedelta(hours=1),
        dt.timedelta(0),
        {"n": ("count", "rid"), "top": ("max", "speed")},
    ).first()
    assert (got.n, got.top) == (1, 5.0)


def test_no_nested_loop_in_the_plans(spark):
    left, right = sample(2, 30, 30, 10, dt.timedelta(hours=1))
    ldf, rdf = spark.createDataFrame(left, L), spark.createDataFrame(right, R)
    day = dt.timedelta(days=1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            plan_of(interval_join(ldf, rdf, "lts", "rts", day, day)),
            plan_of(interval_aggregate(ldf, rdf, "lts", "rts", day, day, {"n": ("count", "rid")})),
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_level_cell_is_never_counted_twice(spark):
    """Every microsecond of a small range as a right row: the count is the window's width."""
    right = spark.range(-300, 300).select(
        F.col("id").alias("rid"), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0,0,0,id/1e6)").alias("rts")
    )
    left = right.select(F.col("rts").alias("lts")).where(F.col("rid").between(-100, 100))
    for lower, upper in ((0, 0), (1, 0), (17, 64), (63, 64), (100, 99)):
        got = interval_aggregate(left, right, "lts", "rts", micros(lower), micros(upper), {"n": ("count", "rid")})
        assert {r.n for r in got.select("n").distinct().collect()} == {lower + upper + 1}
