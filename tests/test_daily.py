import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from siltstone.operators.tables import Layers
from siltstone.plans import daily
from siltstone.plans.models import Fact, Model, default_project
from siltstone.sources.catalog import DatasetSpec, datasets
from tests.conftest import plan_of

ROCKETS = [{"id": "r1", "name": "One", "type": "rocket", "active": True, "cost_per_launch": 1000, "success_rate_pct": 40, "payload_weights": [{"id": "leo", "kg": 450}]}]
PAYLOADS = [{"id": "p1", "mass_kg": 100, "customers": ["x"]}, {"id": "p2", "mass_kg": 50.5, "customers": []}]
CORES = [{"id": "c1", "serial": "B1", "status": "active", "reuse_count": 3}]
EVENTS = [
    {"activityID": "e1", "startTime": "2022-11-01T12:36Z", "cmeAnalyses": [{"speed": 700.0, "type": "C", "halfAngle": 20, "isMostAccurate": True}], "note": "n1"},
    {"activityID": "e2", "startTime": "2022-11-02T00:00Z", "cmeAnalyses": None},
    {"activityID": "e3", "startTime": "2022-09-02T00:00Z", "cmeAnalyses": [{"speed": 1.0}]},
]


def launch(i, at, payloads=("p1", "p2"), **kw):
    record = {"id": i, "flight_number": 1, "name": f"L {i}", "date_utc": at, "rocket": "r1", "success": True, "payloads": list(payloads), "cores": [{"core": "c1"}]}
    return {**record, "links": {"patch": {"small": "s"}}, **kw}


LAUNCHES = [launch("a", "2022-11-01T20:00:00.000Z"), launch("b", "2022-12-01T20:00:00.000Z", success=False)]
WINDOW = ("2022-11-01", "2022-12-31")


@pytest.fixture
def site(spark, tmp_path, as_of):
    """Landed files and layers of one test; ``site.run()`` is a daily run."""

    class Site:
        layers = Layers(spark, str(tmp_path / "layers"))
        location = str(tmp_path / "landed")

        def land(self, **datasets):
            for name, records in datasets.items():
                folder = tmp_path / "landed" / name
                folder.mkdir(parents=True, exist_ok=True)
                body = records if isinstance(records, str) else json.dumps(records)
                (folder / "page.json").write_text(body)

        def run(self, at=as_of, **kw):
            return daily.run(spark, self.layers.root, self.location, at, window=WINDOW, **kw)

        def fact(self, name):
            return self.layers.table("gold", name, "launch_at_utc").read()

        def ids(self, name="launches_performance"):
            return sorted(r.launch_id for r in self.fact(name).collect())

        def alerts(self):
            return sorted((r.severity, r.dataset, r.message) for r in self.layers.alerts().collect())

    out = Site()
    out.land(rockets=ROCKETS, payloads=PAYLOADS, cores=CORES, solar_events=EVENTS, launches=LAUNCHES)
    return out


def test_a_day_from_landed_files_to_published_facts(spark, site, as_of):
    assert site.run() == {"launches_performance": 1, "launch_roi": 1, "space_weather_impact": 1}
    assert site.alerts() == []
    raw = site.layers.table("raw", "launches").read().orderBy("id").first()
    assert (raw.source_endpoint, raw.data_layer, raw.loaded_at) == ("launches", "bronze", as_of)
    assert raw["links.patch.small"] == "s" and json.loads(raw.payloads) == ["p1", "p2"]
    # the event outside the requested window is not loaded
    assert site.layers.table("raw", "solar_events").read().count() == 2
    row = site.fact("launches_performance").first()
    assert (row.launch_id, float(row.total_payload_mass_kg), row.count_cme_events, row.mission_risk_profile) == ("a", 150.5, 1, "MEDIUM RISK")
    assert site.ids("launch_roi") == ["a", "b"]
    assert sorted(r.surrogate_key for r in site.fact("space_weather_impact").collect()) == ["a-e1", "b-NO_EVENT"]
    assert spark.sql("SELECT count(*) AS n FROM gold_launch_roi").first().n == 2
    assert spark.sql("SELECT count(*) AS n FROM silver_cores").first().n == 1


def test_the_next_day_loads_only_newer_launches(site, as_of):
    site.run()
    late = launch("late", "2022-10-01T00:00:00.000Z")
    equal = launch("equal", "2022-11-01T20:00:00.000Z")
    moved = launch("a", "2022-12-20T00:00:00.000Z", ["p1"])
    site.land(launches=[*LAUNCHES, late, equal, moved, launch("new", "2022-12-24T00:00:00.000Z")][1:])
    site.run()
    assert site.ids() == ["a", "new"]
    a = site.fact("launches_performance").where("launch_id = 'a'").first()
    assert a.launch_at_utc == dt.datetime(2022, 12, 20) and float(a.total_payload_mass_kg) == 100.0
    site.run()
    assert site.ids() == ["a", "new"]
    site.run(full_refresh=True)
    assert site.ids() == ["a", "equal", "late", "new"]


def test_a_published_but_empty_fact_stays_empty_unless_told_otherwise(site):
    site.land(launches=[launch("x", "2022-11-01T20:00:00.000Z", success=False)])
    site.run(tag="performance")
    site.land(launches=LAUNCHES)
    site.run(tag="performance")
    assert site.ids() == []
    site.run(tag="performance", empty_target="full")
    assert site.ids() == ["a"]


def test_tags_select_facts(site):
    assert list(site.run(tag="roi")) == ["launch_roi"]
    chosen = [m.full_name for m in default_project().selected("roi")]
    assert sorted(chosen) == ["gold.launch_roi", "silver.payloads", "silver.rockets"] and chosen[-1] == "gold.launch_roi"


def test_a_failing_dataset_stops_no_other(site, as_of):
    site.land(cores="{not json")
    results = daily.ingest(site.layers, site.location, as_of)
    assert results["cores"] is None
    assert {n: v.ok for n, v in results.items() if v} == {"rockets": True, "launches": True, "payloads": True, "solar_events": True}
    assert [a[:2] for a in site.alerts()] == [("CRITICAL", "cores")]


def test_a_rejected_batch_keeps_the_old_rows(site, as_of):
    site.run()
    site.land(launches=[{"id": "z", "name": "no time"}], rockets=[])
    results = daily.ingest(site.layers, site.location, as_of)
    assert not results["launches"].ok and not results["rockets"].ok
    assert site.alerts() == [
        ("WARNING", "launches", "missing columns flight_number, date_utc"),
        ("WARNING", "rockets", "no rows"),
    ]
    assert site.layers.table("raw", "launches").read().count() == 2
    assert site.layers.table("raw", "rockets").read().count() == 1


def test_null_ids_warn_and_load(site, as_of):
    site.land(launches=[*LAUNCHES, launch(None, "2022-12-02T00:00:00Z")])
    verdict = daily.ingest(site.layers, site.location, as_of)["launches"]
    assert verdict.ok and verdict.warnings == ("1 null ids",)
    assert site.layers.table("raw", "launches").read().count() == 3
    assert site.alerts() == [("WARNING", "launches", "1 null ids")]


def test_duplicate_ids_block_everything_after_ingestion(site):
    site.land(launches=[*LAUNCHES, LAUNCHES[0]])
    with pytest.raises(daily.GateFailed, match="unique_launches"):
        site.run()
    assert not site.layers.table("gold", "launch_roi").exists()
    assert ("CRITICAL", "unique_launches", "fail: 1 failing rows") in site.alerts()


def test_stale_sources_block(site, as_of):
    site.run()
    site.land(launches=[])
    with pytest.raises(daily.GateFailed, match="freshness_launches, recency_launches"):
        site.run(as_of + dt.timedelta(days=3))


def test_missing_raw_table_blocks(site):
    site.land(rockets="[")
    with pytest.raises(daily.GateFailed, match="loaded_rockets"):
        site.run()


def test_a_fact_that_fails_its_check_is_not_published(site):
    site.run()
    before = site.ids()
    site.land(launches=[*LAUNCHES, launch("early", "2022-12-20T01:00:00Z")], solar_events=[*EVENTS, {"activityID": "e9", "startTime": "2022-12-20T09:00Z", "cmeAnalyses": [{"speed": 5}]}])
    with pytest.raises(daily.GateFailed, match="launch_after_solar_event"):
        site.run()
    assert site.ids() == before and site.ids("launch_roi") == ["a", "b"]


def test_no_window_means_the_last_sixty_days(site, spark, as_of):
    daily.run(spark, site.layers.root, site.location, as_of)
    # 2022-11-01 is sixty days before the last day of the year, September is not
    events = site.layers.table("raw", "solar_events").read()
    assert sorted(r.activityID for r in events.collect()) == ["e1", "e2"]


def test_many_runs_leave_few_folders(site, spark, tmp_path):
    table = site.layers.table("gold", "many", "at")
    for day in range(1, 13):
        batch = spark.createDataFrame([(day, dt.datetime(2022, 12, day))], "k int, at timestamp_ntz")
        table.publish(table.stage_delete_insert(batch, "k"))
        table.tidy()
    assert len(table.current().parts) <= 5
    assert sorted(r.k for r in table.read().collect()) == list(range(1, 13))
    assert len(list((tmp_path / "layers/gold/many/_versions").iterdir())) == 7


def test_a_rejected_batch_leaves_no_files(site, tmp_path, as_of):
    site.land(launches=[{"id": "z", "name": "no time"}])
    assert not daily.ingest(site.layers, site.location, as_of)["launches"].ok
    assert list((tmp_path / "layers/raw/launches/data").iterdir()) == []


def test_custom_reader(site, spark, as_of):
    class Fixed:
        def read(self, session, spec, location):
            return session.createDataFrame([("c9",)], "id string")

    spec = datasets()["cores"]
    results = daily.ingest(site.layers, "nowhere", as_of, [spec], Fixed())
    assert results["cores"].rows == 1


def test_the_second_run_reads_one_month_of_raw_launches(spark, site, as_of, monkeypatch):
    """The mark reaches the scan: months before it are not listed, and the typed time is pushed down.
    Of the events only those within the fact's reach are read."""
    months = [launch(f"m{m}", f"2022-{m:02d}-15T10:00:00Z") for m in range(1, 12)]
    site.land(launches=[*months, launch("bad time", None)])
    site.run(tag="roi")
    site.run(tag="space_weather")
    site.land(launches=[*months, launch("new", "2022-11-20T10:00:00Z")])
    seen = {}
    for name, tag in (("launch_roi", "roi"), ("space_weather_impact", "space_weather")):
        fact = default_project().models[f"gold.{name}"]
        build = fact.build
        spied = replace(fact, build=lambda f, at, n=name, b=build: seen.setdefault(n, (dict(f), b(f, at)))[1])
        daily.run(spark, site.layers.root, site.location, as_of, window=WINDOW, tag=tag, project=default_project().with_models(spied))

    def parts(df):
        return {f.split("_part=")[1].split("/")[0] for f in df.inputFiles() if "_part=" in f}

    frames, batch = seen["launch_roi"]
    assert parts(frames["raw.launches"]) == {"2022-11"}
    assert "GreaterThanOrEqual(_event_at,2022-11-15T10:00)" in plan_of(frames["raw.launches"])
    frames, batch = seen["space_weather_impact"]
    assert parts(frames["silver.launches"]) == {"2022-11"}
    assert "GreaterThanOrEqual(_event_at,2022-11-08T10:00)" in plan_of(frames["silver.solar_events"])
    assert sorted(r.launch_id for r in site.fact("launch_roi").collect()) == sorted(["bad time", "new", *(m["id"] for m in months)])


def test_a_run_overtaken_by_another_builds_its_fact_again(spark, site, as_of):
    """While the first run is at work, a second one publishes; the first is refused and retries."""
    site.run(tag="roi")
    site.land(launches=[*LAUNCHES, launch("c", "2022-12-05T00:00:00Z"), launch("d", "2022-12-06T00:00:00Z")])
    table = site.layers.table("gold", "launch_roi", "launch_at_utc")
    fact = default_project().models["gold.launch_roi"]
    build, calls = fact.build, []

    def overtaken(frames, at):
        calls.append(at)
        if len(calls) == 1:  # another writer brings launch c
            other = build(frames, at).where("launch_id = 'c'")
            table.commit(lambda: table.stage_delete_insert(other, "launch_id"))
        return build(frames, at)

    project = default_project().with_models(replace(fact, build=overtaken))
    assert site.run(tag="roi", project=project) == {"launch_roi": 3}
    assert len(calls) == 2 and site.ids("launch_roi") == ["a", "b", "c", "d"]


def test_an_added_dataset_is_checked_viewed_and_built_on(spark, site, as_of):
    spec = DatasetSpec("pads", "id string, name string", required=("name",))
    site.land(pads=[{"id": "p", "name": "North"}, {"id": "p", "name": "South"}])
    with pytest.raises(daily.GateFailed, match="unique_pads"):
        site.run(specs=[spec])
    site.land(pads=[{"id": "p", "name": "North"}])
    counts = Fact(
        "counts", lambda f, at: f["gold.launch_roi"].crossJoin(f["silver.pads"]).groupBy("pad").count(), ("gold.launch_roi", "silver.pads"), ("pads",), event_time=None, key="pad"
    )
    pads = Model("pads", lambda f, at: f["raw.pads"].select(F.col("name").alias("pad")), ("raw.pads",))
    project = default_project().with_datasets(spec).with_models(counts, pads)
    assert site.run(project=project, tag="pads") == {"launch_roi": 1, "counts": 1}
    assert [tuple(r) for r in spark.table("gold.counts").collect()] == [("North", 2)]
    assert spark.sql("SELECT pad FROM silver_pads").first().pad == "North"


def test_the_graph_refuses_what_cannot_be_built():
    project = default_project()

    def nothing(f, at):
        return None

    with pytest.raises(ValueError, match="silver.x depends on unknown raw.nowhere"):
        project.with_models(Model("x", nothing, ("raw.nowhere",)))
    with pytest.raises(ValueError, match="depend on each other"):
        project.with_models(Model("x", nothing, ("silver.y",)), Model("y", nothing, ("silver.x",)))
    with pytest.raises(ValueError, match="does not depend on"):
        project.with_models(Fact("x", nothing, ("raw.cores",), key="id", loads="raw.launches"))
    with pytest.raises(ValueError, match="needs a key"):
        project.with_models(Fact("x", nothing, ("raw.cores",), loads="raw.cores"))
    more = project.with_models(Fact("x", nothing, ("gold.launch_roi", "silver.cores"), ("x",), event_time=None))
    levels = [{m.name for m in level} for level in more.levels(more.selected("x"))]
    assert levels == [{"rockets", "payloads", "cores"}, {"launch_roi"}, {"x"}]


def test_a_run_splits_scans_as_often_as_shuffles(spark, site):
    """Published files hold many rows a byte: a split of the usual size is a task of millions."""
    site.run(tag="roi")
    assert spark.conf.get("spark.sql.files.minPartitionNum") == spark.conf.get("spark.sql.shuffle.partitions")


def test_landed_rows_are_brought_together_before_they_are_widened(spark, site, as_of, monkeypatch):
    """Of a dataset split by month, only landed columns, the time and its month change tasks."""
    from siltstone.operators.tables import Table

    staged = {}

    def stage(table, df, *args, stage_refresh=Table.stage_refresh, **kw):
        staged[table.path.rsplit("/", 1)[1]] = df
        return stage_refresh(table, df, *args, **kw)

    monkeypatch.setattr(Table, "stage_refresh", stage)
    daily.ingest(site.layers, site.location, as_of, window=WINDOW)
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    try:
        plans = [staged[name]._jdf.queryExecution().optimizedPlan().toString() for name in ("launches", "solar_events")]
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    for plan in plans:
        above, below = plan.split("RebalancePartitions")
        assert "data_layer" in above and "data_layer" not in below
    raw = site.layers.table("raw", "launches", "_event_at")
    assert sorted(part for part, _ in raw.current().parts) == ["2022-11", "2022-12"]
    rows = raw.read()
    assert rows.columns[-4:] == ["source_endpoint", "data_layer", "ingestion_timestamp", "loaded_at"]
    assert sorted((r.id, r["links.patch.small"], r.payloads) for r in rows.collect()) == [(i, "s", '["p1", "p2"]') for i in "ab"]
    daily.ingest(site.layers, site.location, as_of, window=WINDOW)
    assert raw.read().columns == rows.columns and raw.read().count() == 2
