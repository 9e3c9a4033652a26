"""Physical plans: what reaches the scan, and that no row passes through Python."""

import os

import pytest

from siltstone.plans.registered import queries
from siltstone.session import configure, size_shuffles, work_dir
from tests.conftest import plan_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(spark, name):
    return plan_of(queries()[name](spark, SF_DIR))


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("window_filter", "GreaterThanOrEqual(o_orderdate,1998-11-01T00:00)"),
        ("incremental_new_rows", "GreaterThan(o_orderdate,"),
        ("delete_and_insert", "EqualTo(o_orderstatus,F)"),
        ("interval_join_trailing_24h", "EqualTo(event_type,signup)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


@pytest.mark.parametrize(
    "name, schema",
    [
        ("kpi_status_summary", "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>"),
        ("dim_join_inner", "ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double>"),
        ("dq_unique", "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>"),
        ("interval_join_trailing_24h", "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>"),
    ],
)
def test_only_needed_columns_are_read(spark, name, schema):
    assert schema in plan(spark, name)


@pytest.mark.parametrize("name", ["silver_solar_events", "silver_rockets"])
def test_json_lists_are_parsed_once(spark, name):
    assert plan(spark, name).count("parseJson") == 1


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top5_cheapest")


@pytest.mark.parametrize("name", ["mart_performance", "mart_roi", "mart_weather", "silver_solar_events", "dq_singular_same_day"])
def test_plans_stay_in_the_jvm_without_nested_loops(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for word in ("NestedLoop", "Cartesian", "Python", "Arrow"):
        assert word not in text


def test_session_settings(spark, tmp_path):
    configure(spark, SF_DIR)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert size_shuffles(spark, SF_DIR) == before


def test_shuffles_follow_the_length_of_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with open(tmp_path / "large", "wb") as sparse:
        sparse.truncate(30 * 2**30)
    try:
        configure(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "240"
        configure(spark, str(tmp_path), factor=5)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scratch_folder_is_the_session_s(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_landed_launches_are_not_encoded_and_parsed_again(spark, tmp_path, monkeypatch):
    """Launches are landed from lists as lists; their files still hold what the raw role says."""
    from pyspark.sql import functions as F

    from siltstone.plans import roles

    shown = plan_of(roles.order_launch_records(spark, SF_DIR))
    assert "to_json" not in shown and "structstojson" not in shown.lower()
    parsed = []
    monkeypatch.setattr(roles.F, "from_json", lambda c, shape, read=F.from_json: parsed.append(c) or read(c, shape))
    roles.land(spark, SF_DIR, str(tmp_path / "landed"))
    assert "cores" not in parsed and "payloads" not in parsed
    landed = spark.read.schema("id string, payloads string, cores string").json(str(tmp_path / "landed/launches"))
    assert landed.exceptAll(roles.order_launches(spark, SF_DIR).select("id", "payloads", "cores")).isEmpty()


def test_landing_has_more_tasks_than_row_groups(spark, tmp_path):
    """Launches come from one row group, which only one task can scan; several encode them."""
    from siltstone.plans import roles

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        roles.land(spark, SF_DIR, str(tmp_path / "landed"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "landed/launches").glob("*.json"))) > 1
    landed = spark.read.schema("id string").json(str(tmp_path / "landed/launches"))
    assert landed.exceptAll(roles.order_launches(spark, SF_DIR).select("id")).isEmpty()
    assert landed.count() == roles.order_launches(spark, SF_DIR).count()
