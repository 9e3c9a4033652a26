import datetime as dt

import pytest
from pyspark.sql import functions as F


from siltstone.operators.incremental import add_columns, delete_insert, high_water_mark, newer_than
from siltstone.operators import tables
from siltstone.operators.tables import EVENT_AT, Conflict, Layers, Table

SCHEMA = "k string, at timestamp_ntz, v int"


def day(n, month=1):
    return dt.datetime(2022, month, n)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


@pytest.fixture
def frame(spark):
    return lambda data, schema=SCHEMA: spark.createDataFrame(data, schema)


@pytest.fixture
def fact(spark, tmp_path):
    return Table(spark, str(tmp_path / "fact"), "at")


def test_newer_than_is_strict(frame):
    source = frame([("a", day(1), 1), ("b", day(2), 2), ("c", day(3), 3), ("n", None, 4)])
    mark = high_water_mark(frame([("x", day(2), 0), ("y", day(1), 0)]), "at")
    assert rows(newer_than(source, "at", mark), "k") == [("c",)]
    assert newer_than(source, "at", None).count() == 0
    assert newer_than(source, "at", None, empty_target="full").count() == 4
    assert newer_than(source, "at", mark, first_run=True).count() == 4
    with pytest.raises(ValueError):
        newer_than(source, "at", mark, empty_target="some")


def test_delete_insert_keeps_batch_duplicates_and_null_keys(frame):
    target = frame([("a", day(1), 1), ("b", day(1), 1), (None, day(1), 1)])
    batch = frame([("a", day(2), 2), ("a", day(2), 3), (None, day(2), 2)])
    once = delete_insert(target, batch, "k")
    assert rows(once, "k", "v") == [("a", 2), ("a", 3), ("b", 1), (None, 1), (None, 2)]
    # without null keys a second run changes nothing, each null key is added once more
    twice = delete_insert(once, batch, "k")
    assert rows(twice, "k", "v") == [("a", 2), ("a", 3), ("b", 1), (None, 1), (None, 2), (None, 2)]


def test_add_columns(frame):
    out = add_columns(frame([("a", day(1), 1)]), frame([("b", "new")], "k string, extra string"))
    assert out.columns == ["k", "at", "v", "extra"]
    assert rows(out, "k", "v", "extra") == [("a", 1, None), ("b", None, "new")]


def test_unpublished_table(fact):
    assert not fact.exists()
    with pytest.raises(FileNotFoundError):
        fact.read()


def test_staged_rows_are_invisible_until_published(fact, frame):
    fact.publish(fact.stage_delete_insert(frame([("a", day(1), 1)]), "k"))
    staged = fact.stage_delete_insert(frame([("a", day(2), 2), ("b", day(3, 2), 3)]), "k")
    assert fact.measure(staged, F.max("v").alias("top")) == {"rows": 2, "top": 3}
    assert rows(fact.read(), "k", "v") == [("a", 1)]
    assert rows(fact.frame(staged), "k", "v") == [("a", 2), ("b", 3)]
    assert fact.publish(staged) == 2
    assert rows(fact.read(), "k", "v") == [("a", 2), ("b", 3)]
    assert rows(fact.frame(fact.version(1)), "k", "v") == [("a", 1)]


def test_half_written_version_is_ignored(fact, frame, tmp_path):
    fact.publish(fact.stage_full(frame([("a", day(1), 1)])))
    crashed = tmp_path / "fact" / "_versions" / "00000002"
    crashed.mkdir()
    (crashed / "part-0.json").write_text('{"part": "all", "path": "data/nowhere"}')
    assert rows(fact.read(), "k") == [("a",)]
    assert fact.publish(fact.stage_full(frame([("b", day(1), 1)]))) == 2
    assert rows(fact.read(), "k") == [("b",)]


def test_months_without_replaced_keys_keep_their_files(fact, frame):
    fact.publish(fact.stage_full(frame([("a", day(1, 1), 1), ("b", day(1, 2), 1), ("c", day(2, 2), 1), ("n", None, 1)])))
    before = dict(fact.current().parts)
    assert set(before) == {"2022-01", "2022-02", "none"}
    fact.publish(fact.stage_delete_insert(frame([("b", day(5, 3), 2)]), "k"))
    after = {}
    for part, path in fact.current().parts:
        after.setdefault(part, []).append(path)
    assert after["2022-01"] == [before["2022-01"]] and after["none"] == [before["none"]]
    assert after["2022-02"] != [before["2022-02"]]
    assert rows(fact.read(), "k", "v") == [("a", 1), ("b", 2), ("c", 1), ("n", 1)]
    fact.publish(fact.stage_delete_insert(frame([("d", day(6, 3), 2), ("n", day(7, 3), 9)]), "k"))
    assert rows(fact.read(), "k", "v") == [("a", 1), ("b", 2), ("c", 1), ("d", 2), ("n", 9)]
    assert fact.high_water_mark() == day(7, 3)
    compact = fact.stage_compacted()
    assert len(compact.parts) == len({p for p, _ in compact.parts})
    fact.publish(compact)
    assert rows(fact.read(), "k", "v") == [("a", 1), ("b", 2), ("c", 1), ("d", 2), ("n", 9)]


def test_table_level_delete_insert_equals_the_frame_level_one(fact, frame):
    target = frame([(f"k{i % 40}", day(1 + i % 28, 1 + i % 5), i) for i in range(120)] + [(None, day(1), 1)])
    batch = frame([(f"k{i}", day(3, 6), 1000 + i) for i in range(30, 60)] + [(None, None, 2), ("k31", day(1, 1), 7)])
    fact.publish(fact.stage_delete_insert(target, "k"))
    fact.publish(fact.stage_delete_insert(batch, "k"))
    assert rows(fact.read()) == rows(delete_insert(target, batch, "k"))


def test_new_columns_are_appended_and_vanished_ones_null(fact, frame):
    fact.publish(fact.stage_delete_insert(frame([("a", day(1), 1)]), "k"))
    fact.publish(fact.stage_delete_insert(frame([("b", day(2), "x")], "k string, at timestamp_ntz, extra string"), "k"))
    fact.publish(fact.stage_delete_insert(frame([("c", day(3), 3)]), "k"))
    assert fact.read().columns == ["k", "at", "v", "extra"]
    assert rows(fact.read(), "k", "v", "extra") == [("a", 1, None), ("b", None, "x"), ("c", 3, None)]


def test_expiry_keeps_what_the_kept_versions_refer_to(fact, frame, tmp_path):
    for n in range(1, 5):
        fact.publish(fact.stage_delete_insert(frame([(f"k{n}", day(n, n), n), ("k0", day(1, 1), n)]), "k"))
    fact.stage_full(frame([("rejected", day(1), 1)]))
    want = rows(fact.read())
    before = len(list((tmp_path / "fact" / "data").iterdir()))
    fact.expire(keep=2)
    assert rows(fact.read()) == want and len(rows(fact.frame(fact.version(3)))) == 4
    assert sorted(p.name for p in (tmp_path / "fact" / "_versions").iterdir()) == ["00000003", "00000004"]
    assert len([p for p in (tmp_path / "fact" / "data").iterdir() if p.is_dir()]) < before
    assert fact.publish(fact.stage_compacted()) == 5
    assert rows(fact.read()) == want


def test_empty_batch_and_empty_table(fact, frame):
    fact.publish(fact.stage_delete_insert(frame([]), "k"))
    assert fact.exists() and fact.read().count() == 0 and fact.high_water_mark() is None
    fact.publish(fact.stage_delete_insert(frame([("a", day(1), 1)]), "k"))
    fact.publish(fact.stage_delete_insert(frame([]), "k"))
    assert rows(fact.read(), "k") == [("a",)]


def test_refresh_keeps_the_structure(spark, tmp_path, frame):
    raw = Table(spark, str(tmp_path / "raw"))
    raw.publish(raw.stage_refresh(frame([("a", day(1), 1)])))
    raw.publish(raw.stage_refresh(frame([(7, "b")], "v long, k string")))
    assert raw.read().schema.simpleString() == "struct<k:string,at:timestamp_ntz,v:int>"
    assert rows(raw.read()) == [("b", None, 7)]
    with pytest.raises(ValueError, match="unknown columns z"):
        raw.stage_refresh(frame([("a", 1)], "k string, z int"))
    assert rows(raw.read(), "k") == [("b",)]


def test_failed_write_leaves_the_old_rows(spark, tmp_path, frame):
    raw = Table(spark, str(tmp_path / "raw"))
    raw.publish(raw.stage_refresh(frame([("1", day(1), 1)])))
    with pytest.raises(Exception):
        raw.publish(raw.stage_refresh(frame([("x", day(1), 1)]).withColumn("v", F.col("k").cast("int"))))
    assert rows(raw.read(), "k") == [("1",)]


def test_layers_and_alerts(spark, tmp_path, frame, as_of):
    layers = Layers(spark, str(tmp_path))
    layers.ensure()
    layers.ensure()
    assert {"raw", "silver", "gold"} <= {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    layers.view("silver", "things", frame([("a", day(1), 1)]))
    assert spark.sql("SELECT k FROM silver_things").first().k == "a"
    assert layers.alerts().count() == 0
    layers.alert(as_of, "launches", "boom")
    layers.alert(as_of, "rockets", "no rows", "WARNING")
    assert rows(layers.alerts(), "severity", "dataset", "message") == [
        ("CRITICAL", "launches", "boom"),
        ("WARNING", "rockets", "no rows"),
    ]


def test_of_two_publishers_one_builds_again(spark, tmp_path, frame):
    """Both build on version 1; whoever comes second is refused, stages again, and nothing is lost."""
    first, second = (Table(spark, str(tmp_path / "fact"), "at") for _ in range(2))
    first.publish(first.stage_delete_insert(frame([("a", day(1), 1), ("b", day(1), 1)]), "k"))
    mine = first.stage_delete_insert(frame([("a", day(2), 2)]), "k")
    other = second.stage_delete_insert(frame([("b", day(2), 3), ("c", day(2, 2), 3)]), "k")
    assert first.publish(mine) == 2
    with pytest.raises(Conflict, match="version 2 was published after 1"):
        second.publish(other)
    second.discard(other)
    assert second.commit(lambda: second.stage_delete_insert(frame([("b", day(2), 3), ("c", day(2, 2), 3)]), "k")) == 3
    assert rows(first.read(), "k", "v") == [("a", 2), ("b", 3), ("c", 3)]
    assert rows(first.frame(first.version(2)), "k", "v") == [("a", 2), ("b", 1)]


def test_two_writers_at_once_lose_no_version(spark, tmp_path, frame):
    from concurrent.futures import ThreadPoolExecutor

    def write(n):
        table = Table(spark, str(tmp_path / "fact"), "at")
        return table.commit(lambda: table.stage_delete_insert(frame([(f"k{n}", day(n), n)]), "k"), tries=20)

    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(write, range(1, 5)))
    assert sorted(numbers) == [1, 2, 3, 4]
    assert rows(Table(spark, str(tmp_path / "fact")).read(), "v") == [(1,), (2,), (3,), (4,)]


def test_a_writer_that_died_holds_nobody_up(fact, frame, tmp_path, monkeypatch):
    fact.publish(fact.stage_full(frame([("a", day(1), 1)])))
    claimed = tmp_path / "fact" / "_versions" / "00000002"
    claimed.mkdir()
    (claimed / "_owner").write_text("")
    monkeypatch.setattr(tables, "CLAIM_SECONDS", 0.5)
    assert fact.publish(fact.stage_full(frame([("b", day(1), 1)]))) == 3
    assert rows(fact.read(), "k") == [("b",)]
    fact.expire(keep=1)
    assert [p.name for p in (tmp_path / "fact" / "_versions").iterdir()] == ["00000003"]


def test_tables_of_the_catalog(spark, tmp_path, frame):
    layers = Layers(spark, str(tmp_path), prefix="t1_")
    layers.ensure()
    gold, raw = layers.table("gold", "things", "at"), layers.table("raw", "odd names")
    raw.publish(raw.stage_refresh(frame([(1, "x")], "`a.b` int, `c d` string")))
    gold.publish(gold.stage_delete_insert(frame([("a", day(1), 1), ("b", day(1, 2), 2), ("n", None, 3)]), "k"))
    other = spark.newSession()
    assert [tuple(r) for r in other.table("t1_raw.odd_names").collect()] == [(1, "x")]
    before = other.table("t1_gold.things")
    assert rows(before) == rows(gold.read())
    staged = gold.stage_delete_insert(frame([("b", day(3, 2), "new")], "k string, at timestamp_ntz, w string"), "k")
    assert rows(other.table("t1_gold.things")) == rows(before)
    gold.publish(staged)
    assert other.table("t1_gold.things").columns == ["k", "at", "v", "w"]
    assert rows(other.table("t1_gold.things"), "k", "w") == [("a", None), ("b", "new"), ("n", None)]
    for n in range(3):
        gold.publish(gold.stage_delete_insert(frame([("a", day(4 + n), n)]), "k"))
    gold.expire(keep=2)
    held = [r.tableName for r in other.sql("SHOW TABLES IN t1_gold LIKE 'things__v*'").collect()]
    assert sorted(h.split("_")[-2] for h in held) == ["v00000004", "v00000005"]
    assert rows(other.table("t1_gold.things"), "k", "v") == [("a", 2), ("b", None), ("n", 3)]
    # a session that knows nothing yet finds what is published
    again = Layers(spark, str(tmp_path), prefix="t2_")
    assert again.attach() == ["t2_gold.things", "t2_raw.odd_names"]
    assert rows(spark.table("t2_gold.things"), "k", "v") == [("a", 2), ("b", None), ("n", 3)]


def test_empty_table_of_the_catalog(spark, tmp_path, frame):
    table = Layers(spark, str(tmp_path), prefix="t3_").table("gold", "none", "at")
    table.publish(table.stage_delete_insert(frame([]), "k"))
    assert spark.table("t3_gold.none").count() == 0


def test_rows_since_a_time_come_from_few_months(spark, tmp_path, frame):
    from tests.conftest import plan_of

    table = Table(spark, str(tmp_path / "raw"), EVENT_AT)
    data = [(f"k{m}-{d}", day(d, m), m) for m in range(1, 13) for d in (1, 20)] + [("n", None, 0)]
    table.publish(table.stage_refresh(frame(data).withColumn(EVENT_AT, F.col("at"))))
    assert table.read().columns == ["k", "at", "v"]
    since = table.since(day(10, 11))
    assert rows(since, "k") == [("k11-20",), ("k12-1",), ("k12-20",), ("n",)]
    assert {f.split("_part=")[1].split("/")[0] for f in since.inputFiles()} == {"2022-11", "2022-12", "none"}
    assert f"PushedFilters: [Or(GreaterThanOrEqual({EVENT_AT},2022-11-10T00:00),IsNull({EVENT_AT}))]" in plan_of(since)


def rows_scanned(df):
    """Rows that the scan of a frame gave, once it has run."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.sparkSession.createDataFrame([], df.schema).unionByName(df)
        again.collect()
        scan, todo = 0, [again._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            if node.nodeName().startswith("Scan parquet"):
                scan += node.metrics().apply("numOutputRows").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return scan
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_keys_skip_row_groups_by_bloom_filters(spark, tmp_path):
    """Every month holds keys from the whole range, so only Bloom filters tell which has a key."""
    n = F.col("id")
    data = spark.range(24_000).select(
        F.md5(n.cast("string")).alias("k"), F.make_timestamp_ntz(F.lit(2022), n % 12 + 1, F.lit(3), F.lit(0), F.lit(0), F.lit(0)).alias("at"), n.alias("v")
    )
    table = Table(spark, str(tmp_path / "fact"), "at", key="k")
    table.publish(table.stage_full(data))
    version = table.current()
    absent = spark.range(15).select(F.md5((n + 10**6).cast("string")).alias("k"))
    assert rows_scanned(table.with_keys(version, absent, "k", 15)) <= 2000
    present = spark.range(1).select(F.md5((n + 4).cast("string")).alias("k"))
    found = table.with_keys(version, present, "k", 1)
    assert rows(found, "v") == [(4,)] and rows_scanned(found) <= 4000
    before = dict(version.parts)
    batch = present.select("k", F.lit(dt.datetime(2022, 12, 9)).cast("timestamp_ntz").alias("at"), F.lit(-1).cast("long").alias("v"))
    staged = table.stage_delete_insert(batch, "k")
    kept = dict(p for p in staged.parts if p[0] != "2022-12")
    assert {m for m in before if m != "2022-12" and kept[m] != before[m]} == {"2022-05"}
    # more keys than are looked up by value
    many = spark.range(5_000).select(F.md5((n * 2).cast("string")).alias("k"))
    assert table.with_keys(version, many, "k", 5_000).count() == 5_000


def test_months_are_written_without_sorting_the_rows(spark, tmp_path):
    """The rows a task writes are not held in memory to be sorted by month, nor lost where a task
    has more months than it writes side by side."""
    spark.sql("CREATE TABLE unsorted_months (k INT, m STRING) USING parquet PARTITIONED BY (m)")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO unsorted_months SELECT CAST(id AS INT), CAST(id % 3 AS STRING) FROM range(9)").first()[0]
    finally:
        spark.sql("DROP TABLE unsorted_months")
    assert "Sort" not in plan
    rows = spark.range(0, 3000, 1, 1).selectExpr("id AS k", "timestampadd(MONTH, id % 100, timestamp_ntz'2000-01-01 00:00:00') AS at")
    table = Table(spark, str(tmp_path / "t"), "at")
    table.publish(table.stage_full(rows.coalesce(1)))
    assert len(table.current().parts) == 100
    assert sorted(tuple(r) for r in table.read().collect()) == sorted(tuple(r) for r in rows.collect())


def test_a_published_state_is_read_once(spark, tmp_path):
    """Asking for the newest version again, or for folders in use, starts no job."""
    table = Table(spark, str(tmp_path / "t"), "at")
    table.publish(table.stage_full(spark.sql("SELECT 1 AS k, timestamp_ntz'2000-01-01 00:00:00' AS at")))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("versions", "")
    try:
        version, used = table.current(), table._runs(table._published())
        assert len(tracker.getJobIdsForGroup("versions")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert version.base == 1 and used == {path.split("/")[1] for _, path in version.parts}
