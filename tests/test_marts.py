"""Golden rows of the silver views, facts, KPIs and reports, worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest

from siltstone.operators import tables
from siltstone.plans import gold, kpi, reports, silver
from siltstone.sources.catalog import datasets
from tests.conftest import plan_of

AT = dt.datetime(2022, 11, 10, 12)
H, D, US = dt.timedelta(hours=1), dt.timedelta(days=1), dt.timedelta(microseconds=1)


def iso(t):
    return t.isoformat() + "Z"


def frame(spark, name, records):
    """Rows of a raw dataset; fields left out are null."""
    schema = datasets()[name].schema.add("ingestion_timestamp", "timestamp_ntz")
    return spark.createDataFrame([{"ingestion_timestamp": AT, **r} for r in records], schema)


@pytest.fixture(scope="module")
def raw(spark):
    launch = lambda i, at, ok, payloads, rocket="r1": {
        "id": i, "flight_number": 1, "name": f"L {i}", "date_utc": iso(at), "rocket": rocket, "success": ok, "payloads": payloads,
    }
    launches = [
        launch("plain", AT, True, '["p1", "p2"]'),
        launch("twice", AT + 100 * D, True, '["p1", "p1"]'),
        launch("failed", AT, False, '["p1"]'),
        launch("unknown_outcome", AT, None, '["p1"]'),
        launch("no_payload", AT + 200 * D, True, "[]"),
        launch("null_payload", AT + 200 * D, True, None),
        launch("lost_payload", AT + 200 * D, True, '["nowhere"]'),
        launch("half_lost", AT + 200 * D, True, '["nowhere", "p2"]'),
        launch("null_mass", AT + 200 * D, True, '["p_null"]'),
        launch("zero_mass", AT + 200 * D, True, '["p_zero"]'),
        launch("no_rocket", AT, True, '["p1"]', "r_lost"),
        launch("same", AT + 300 * D, True, '["p1"]'),
        launch("same", AT + 300 * D, True, '["p2"]'),
    ]
    payloads = [
        {"id": "p1", "mass_kg": 100.0, "customers": '["Agency", "Other"]', "reused": True, "type": "Sat", "orbit": "LEO", "name": "one"},
        {"id": "p2", "mass_kg": 50.5, "customers": "[]"},
        {"id": "p_null"},
        {"id": "p_zero", "mass_kg": 0.0},
    ]
    rockets = [{"id": "r1", "name": "Small One", "type": "rocket", "active": False, "cost_per_launch": 6700000, "success_rate_pct": 40, "payload_weights": '[{"id": "leo", "kg": 450, "lb": 992}]'}]
    event = lambda i, at, speed, **kw: {
        "activityID": i, "startTime": at if isinstance(at, str) else iso(at), "catalog": "c", "note": f"note {i}", "sourceLocation": "N20E15",
        "cmeAnalyses": f'[{{"speed": {speed}, "type": "C", "halfAngle": 30.5, "isMostAccurate": true}}, {{"speed": 9999}}]', **kw,
    }
    solar = [
        event("at_launch", AT, 500),
        event("day_before", AT - D, 1000.1),
        event("too_early", AT - D - US, 3000),
        event("after", AT + H, 4000),
        event("week_before", AT - 7 * D, 1),
        event("week_after", AT + 7 * D, 1),
        event("too_far", AT + 7 * D + US, 1),
        event("medium", AT + 100 * D - H, 500.1),
        event("minutes", "2023-05-29T12:00Z", 1000),
        event("no_speed", AT, "null"),
        event("no_analysis", AT, 1, cmeAnalyses="[]"),
        event("null_analysis", AT, 1, cmeAnalyses=None),
    ]
    return {n: frame(spark, n, r) for n, r in {"launches": launches, "payloads": payloads, "rockets": rockets, "solar_events": solar}.items()}


@pytest.fixture(scope="module")
def views(raw):
    return {n: getattr(silver, n)(df) for n, df in raw.items()}


def test_silver_schemas(spark, views):
    types = {n: ", ".join(f"{c} {t}" for c, t in df.dtypes) for n, df in views.items()}
    assert types["launches"] == (
        "launch_id string, flight_number bigint, launch_name string, launch_at_utc timestamp_ntz, rocket_id string, "
        "is_success boolean, details string, payload_ids string, core_details string, ingested_at timestamp_ntz"
    )
    assert types["rockets"] == (
        "rocket_id string, rocket_name string, rocket_type string, is_active boolean, cost_per_launch_usd decimal(38,18), "
        "success_rate_pct int, max_payload_kg_leo decimal(38,18), ingested_at timestamp_ntz"
    )
    assert types["payloads"] == (
        "payload_id string, payload_name string, payload_type string, is_payload_reused boolean, mass_kg decimal(38,18), "
        "orbit_code string, primary_customer string, ingested_at timestamp_ntz"
    )
    assert types["solar_events"] == (
        "activityid string, catalog_source string, event_at_utc timestamp_ntz, speed_km_s decimal(38,18), cme_type string, "
        "half_angle decimal(38,18), is_most_accurate boolean, source_location string, event_description string, ingested_at timestamp_ntz"
    )
    cores = silver.cores(frame(spark, "cores", [{"id": "c", "serial": "B1", "status": "lost", "reuse_count": 2, "rtls_landings": 1, "asds_landings": None}]))
    assert tuple(cores.first()) == ("c", "B1", "lost", 2, 1, None, AT)


def test_silver_rows(views):
    assert tuple(views["rockets"].first()) == ("r1", "Small One", "rocket", False, Decimal("6700000.0000"), 40, Decimal("450.0000"), AT)
    payloads = {r.payload_id: r for r in views["payloads"].collect()}
    assert tuple(payloads["p1"]) == ("p1", "one", "Sat", True, Decimal("100.0000"), "LEO", "Agency", AT)
    assert payloads["p2"].primary_customer is None and payloads["p_null"].mass_kg is None
    solar = {r.activityid: r for r in views["solar_events"].collect()}
    assert len(solar) == 9 and not {"no_speed", "no_analysis", "null_analysis"} & set(solar)
    assert solar["minutes"].event_at_utc == dt.datetime(2023, 5, 29, 12)
    assert tuple(solar["day_before"])[3:9] == (Decimal("1000.1000"), "C", Decimal("30.5000"), True, "N20E15", "note day_before")


def test_performance(views, as_of):
    df = gold.performance(views["launches"], views["rockets"], views["payloads"], views["solar_events"], as_of)
    assert df.columns == [
        "launch_id", "launch_name", "launch_at_utc", "rocket_name", "cost_per_launch_usd", "total_payload_mass_kg",
        "usd_per_kg", "count_cme_events", "peak_cme_speed", "mission_risk_profile", "processed_at",
    ]
    rows = [
        (r.launch_id, None if r.total_payload_mass_kg is None else float(r.total_payload_mass_kg), round(r.usd_per_kg, 6), r.count_cme_events, float(r.peak_cme_speed), r.mission_risk_profile)
        for r in df.collect()
    ]
    cost = 6700000
    want = [
        ("plain", 150.5, round(cost / 150.5, 6), 2, 1000.1, "HIGH RISK"),
        ("twice", 200.0, round(cost / 200, 6), 1, 500.1, "MEDIUM RISK"),
        ("no_payload", None, 0.0, 1, 1000.0, "MEDIUM RISK"),
        ("null_payload", None, 0.0, 1, 1000.0, "MEDIUM RISK"),
        ("lost_payload", None, 0.0, 1, 1000.0, "MEDIUM RISK"),
        ("half_lost", 50.5, round(cost / 50.5, 6), 1, 1000.0, "MEDIUM RISK"),
        ("null_mass", None, 0.0, 1, 1000.0, "MEDIUM RISK"),
        ("zero_mass", 0.0, 0.0, 1, 1000.0, "MEDIUM RISK"),
        # one id twice: merged sums on both rows, no event in the day before
        ("same", 150.5, round(cost / 150.5, 6), 0, 0.0, "LOW RISK"),
        ("same", 150.5, round(cost / 150.5, 6), 0, 0.0, "LOW RISK"),
    ]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_roi(raw, views, as_of):
    df = gold.roi(raw["launches"], views["rockets"], views["payloads"], as_of)
    assert df.columns == ["launch_id", "rocket_name", "total_payload_mass_kg", "cost_per_launch_usd", "usd_per_kg", "launch_at_utc", "processed_at"]
    rows = {r.launch_id: (r.total_payload_mass_kg, r.usd_per_kg) for r in df.collect()}
    assert df.count() == 8
    assert {k: None if v[0] is None else float(v[0]) for k, v in rows.items()} == {
        "plain": 150.5, "twice": 200.0, "failed": 100.0, "unknown_outcome": 100.0, "half_lost": 50.5, "null_mass": None, "zero_mass": 0.0, "same": 150.5,
    }
    assert rows["null_mass"][1] is None and rows["zero_mass"][1] is None
    assert rows["twice"][1] == pytest.approx(33500.0)


def test_weather(views, as_of):
    df = gold.weather(views["launches"], views["solar_events"], as_of)
    assert df.columns == ["surrogate_key", "launch_name", "launch_at_utc", "is_success", "solar_event_id", "solar_event_at", "hours_diff", "nasa_note", "processed_at"]
    rows = df.collect()
    plain = {r.solar_event_id: r.hours_diff for r in rows if r.launch_name == "L plain"}
    assert plain == pytest.approx(
        {"at_launch": 0.0, "day_before": 24.0, "too_early": 24 + 1 / 3.6e9, "after": 1.0, "week_before": 168.0, "week_after": 168.0}
    )
    assert {r.launch_name for r in rows if r.surrogate_key == f"{r.launch_name[2:]}-NO_EVENT"} == {"L same"}
    assert len([r for r in rows if r.surrogate_key == "same-NO_EVENT"]) == 2
    failed = next(r for r in rows if r.surrogate_key == "failed-at_launch")
    assert failed.is_success is False and failed.nasa_note == "note at_launch"


def test_pairs_bring_what_their_launch_alone_decides(spark, views, as_of, tmp_path, monkeypatch):
    """The month a pair is stored in, and both times as numbers, are not computed pair by pair."""
    whole = gold.weather(views["launches"], views["solar_events"], as_of)
    parted = gold.weather(views["launches"], views["solar_events"], as_of, parted=True)
    for df in (whole, parted):
        top = df._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
        assert "timestampdiff" not in top.lower() and "date_format" not in top
    table = tables.Table(spark, str(tmp_path / "impact"), "launch_at_utc")
    with monkeypatch.context() as at:
        at.setattr(tables, "month_of", None)
        staged = table.stage_full(parted)
    table.publish(staged)
    assert table.read().columns == whole.columns
    assert sorted(map(str, table.read().collect())) == sorted(map(str, whole.collect()))
    months = {r.m for r in whole.selectExpr("coalesce(date_format(launch_at_utc, 'yyyy-MM'), 'none') AS m").distinct().collect()}
    assert {part for part, _ in staged.parts} == months
    table.publish(table.stage_delete_insert(parted, "surrogate_key"))
    assert sorted(map(str, table.read().collect())) == sorted(map(str, whole.collect()))


def test_mart_plans_have_no_nested_loops(spark, views, as_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            plan_of(gold.performance(views["launches"], views["rockets"], views["payloads"], views["solar_events"], as_of)),
            plan_of(gold.weather(views["launches"], views["solar_events"], as_of)),
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_reports(spark, raw, views, as_of):
    roi = gold.roi(raw["launches"], views["rockets"], views["payloads"], as_of)
    cheapest = reports.cheapest(roi)
    assert "TakeOrderedAndProject" in plan_of(cheapest)
    assert [r.launch_id for r in cheapest.collect()] == ["twice", "plain", "same", "failed", "unknown_outcome"]
    assert [r.usd_per_kg for r in reports.cheapest(roi, 8).collect()][-2:] == [None, None]
    weather = gold.weather(views["launches"], views["solar_events"], as_of)
    near = reports.under_solar_influence(weather).collect()
    assert [r.hours_diff for r in near] == sorted(r.hours_diff for r in near)
    assert all(r.solar_event_id for r in near)
    assert reports.influence_message(weather) == f"{len(near)} launches under solar influence"
    assert reports.influence_message(weather.where("solar_event_id IS NULL")).startswith("no launch")
    coverage = reports.time_coverage({"launches": (views["launches"], "launch_at_utc"), "solar_events": (views["solar_events"], "event_at_utc")})
    assert {tuple(r) for r in coverage.collect()} == {
        ("launches", AT, AT + 300 * D, 13),
        ("solar_events", AT - 7 * D, dt.datetime(2023, 5, 29, 12), 9),
    }
    assert reports.raw_launch_sample(raw["launches"]).columns == ["id", "name", "success", "ingestion_timestamp"]
    assert reports.raw_launch_sample(raw["launches"]).count() == 5
    assert reports.solar_sample(views["solar_events"]).first().activityid == "week_before"
    assert reports.rocket_overview(views["rockets"]).columns == ["rocket_name", "cost_per_launch_usd", "success_rate_pct"]
    performance = gold.performance(views["launches"], views["rockets"], views["payloads"], views["solar_events"], as_of)
    assert reports.performance_sample(performance).first().launch_id == "plain"
    views["rockets"].createOrReplaceTempView("silver_rockets")
    assert reports.ask(spark, "SELECT count(*) AS n FROM silver_rockets").first().n == 1


def test_kpis(spark):
    t = lambda y, d: dt.datetime(y, 1, 1) + d * D
    df = spark.createDataFrame(
        [("x", t(2020, 0), True, 1.0), ("x", t(2020, 3), False, 2.0), ("x", t(2021, 0), None, None), ("y", t(2020, 1), False, 4.0), ("x", t(2020, 9), False, 5.5), ("x", t(2020, 4), False, None)],
        "family string, at timestamp_ntz, ok boolean, mass double",
    )
    rates = {r.year: (r.success_rate, r.launches) for r in kpi.success_rate_by_year(df, "at", "ok").collect()}
    assert rates == {2020: (0.2, 5), 2021: (None, 0)}
    assert {(r.family, r.ok): r.launches for r in kpi.density(df, "family", "ok").collect()}[("x", False)] == 3
    failures = kpi.mean_days_between(df.where("NOT ok"), "family", "at")
    assert {r.family: (r.failures, r.mean_days_between) for r in failures.collect()} == {"x": (3, 3.0), "y": (1, None)}
    summary = {r.family: (r.total, r.avg_payload) for r in kpi.status_summary(df, "family", "mass").collect()}
    assert summary == {"x": (5, pytest.approx(8.5 / 3)), "y": (1, 4.0)}
