import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import types as T

from siltstone.sources.catalog import CONTRACTS, DatasetSpec, contract, datasets
from siltstone.sources.flatten import flatten_struct
from siltstone.sources.landed import LandedReader, in_window, read_responses, records_at

EVENT = "id long, name string, tags string, place struct<x: double>"


@pytest.fixture
def land(tmp_path):
    def write(body, name="page.json"):
        folder = tmp_path / "landed"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(body if isinstance(body, str) else json.dumps(body, ensure_ascii=False), "utf-8")
        return str(folder)

    return write


def spec(json_path=None, **kw):
    return DatasetSpec("things", "id long, name string, tags string, place struct<x: double>", json_path=json_path, **kw)


def records(spark, location, json_path=None):
    return sorted(tuple(r) for r in read_responses(spark, spec(json_path), location).select("id", "name").collect())


def test_list_of_objects(spark, land):
    assert records(spark, land([{"id": 1, "name": "a"}, {"id": 2}])) == [(1, "a"), (2, None)]


def test_single_object(spark, land):
    assert records(spark, land({"id": 1, "name": "a"})) == [(1, "a")]


def test_empty_list_keeps_the_columns(spark, land):
    df = read_responses(spark, spec(), land([]))
    assert df.count() == 0 and df.columns == ["id", "name", "tags", "place"]


def test_several_pages(spark, land):
    land([{"id": 1}], "a.json")
    assert records(spark, land([{"id": 2}], "b.json")) == [(1, None), (2, None)]


def test_json_lines(spark, land):
    location = land('{"id": 1}\n{"id": 2}\n')
    assert read_responses(spark, spec(json_lines=True), location).count() == 2


def test_malformed_response_fails(spark, land):
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        records(spark, land('[{"id": 1'))


@pytest.mark.parametrize(
    "body, path, want",
    [
        ({"events": [{"id": 1}, {"id": 2}]}, "events", [1, 2]),
        ({"data": {"events": [{"id": 1}, {"id": 2}, {"id": 3}], "count": 3, "page": 1}, "meta": {}}, "data.events", [1, 2, 3]),
        ({"level1": {"level2": {"level3": [{"id": 1}, {"id": 2}]}}}, "level1.level2.level3", [1, 2]),
        ({"data": {"events": {"id": 7}}}, "data.events", [7]),
        ({"other": "data"}, "data.events", []),
        ({"data": {"other": 1}}, "data.events", []),
        ({"data": "not_a_dict"}, "data.events", []),
        ({"data": {"events": []}}, "data.events", []),
        ({"data": {"events": None}}, "data.events", []),
        ([{"id": 1}], "data", []),
    ],
)
def test_record_path(spark, land, body, path, want):
    assert [r[0] for r in records(spark, land(body), path)] == want


def test_record_path_keeps_nested_text(spark):
    body = json.dumps({"d": [{"id": 1, "name": "é 名 🚀", "tags": ["x", {"a": 1}], "place": {"x": 1.5}}]})
    df = records_at(spark.createDataFrame([(body,)], "b string"), "b", "d", T.StructType.fromDDL(EVENT))
    row = df.first()
    assert (row.name, row.tags, row.place.x) == ("é 名 🚀", '["x",{"a":1}]', 1.5)


def test_record_path_rejects_malformed_bodies(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        records_at(spark.createDataFrame([('{"d": [',)], "b string"), "b", "d", T.StructType.fromDDL(EVENT)).collect()


def test_unicode_and_nested_text(spark, land):
    row = read_responses(spark, spec(), land([{"id": 1, "name": "é 名 🚀", "tags": ["x", "y"]}])).first()
    assert row.name == "é 名 🚀" and json.loads(row.tags) == ["x", "y"]


def test_flattening(spark, land):
    nested = DatasetSpec("n", "id long, a struct<b: struct<c: string, d: array<int>>, e: int>, l array<struct<x: int>>")
    flat = flatten_struct(read_responses(spark, nested, land([{"id": 1, "a": {"b": {"c": "v", "d": [1]}, "e": 2}, "l": [{"x": 1}]}])))
    assert flat.columns == ["id", "a.b.c", "a.b.d", "a.e", "l"]
    assert tuple(flat.first())[:4] == (1, "v", [1], 2)
    assert flatten_struct(flat.select("id"), "_").columns == ["id"]


def test_launch_schema_reads_a_full_record(spark, land):
    record = {
        "id": "a1",
        "flight_number": 1,
        "date_utc": "2006-03-24T22:30:00.000Z",
        "success": False,
        "failures": [{"time": 33}],
        "payloads": ["p1"],
        "links": {"patch": {"small": "s"}, "flickr": {"small": [], "original": ["o"]}, "webcast": "w"},
    }
    flat = flatten_struct(read_responses(spark, datasets()["launches"], land([record])))
    row = flat.first()
    assert row["links.patch.small"] == "s" and row["links.flickr.original"] == ["o"]
    assert json.loads(row.payloads) == ["p1"] and row.success is False and row.cores is None


def test_catalog():
    specs = datasets()
    assert list(specs) == ["rockets", "launches", "payloads", "cores", "solar_events"]
    assert all(s.layer == "bronze" for s in specs.values())
    assert specs["launches"].required == ("id", "flight_number", "date_utc")
    assert specs["solar_events"].required == ("activityID", "startTime")
    assert specs["solar_events"].window(dt.date(2022, 12, 31)) == ("2022-11-01", "2022-12-31")
    assert specs["launches"].window(dt.date(2022, 12, 31)) is None


def test_request_window(spark, land):
    location = land([{"activityID": str(i), "startTime": t} for i, t in enumerate(["2022-10-31T23:59Z", "2022-11-01T00:00Z", "2022-12-31T23:59Z"])])
    solar = datasets()["solar_events"]
    df = in_window(read_responses(spark, solar, location), solar, ("2022-11-01", "2022-12-31"))
    assert sorted(r.activityID for r in df.collect()) == ["1", "2"]
    assert in_window(df, solar, None) is df


def test_default_reader_looks_below_the_dataset_name(spark, tmp_path):
    (tmp_path / "cores").mkdir()
    (tmp_path / "cores" / "p.json").write_text('[{"id": "c"}]')
    assert LandedReader().read(spark, datasets()["cores"], str(tmp_path)).count() == 1
    assert LandedReader().read(spark, replace(datasets()["cores"], json_path="x"), str(tmp_path)).count() == 0


def test_contracts(spark):
    launches = contract("launches")
    good = spark.createDataFrame([("n", "d", 1, True)], "name string, date_utc string, flight_number int, success boolean")
    assert launches.validate(good) is True
    with pytest.raises(ValueError, match="flight_number, success"):
        launches.validate(good.drop("success", "flight_number").where("false"))
    with pytest.raises(ValueError, match="no rows"):
        launches.validate(good.where("false"))
    with pytest.raises(ValueError, match="no contract"):
        contract("unknown")
    assert set(CONTRACTS) == {"launches"}


def streamed(text, path=""):
    import io

    from siltstone.sources.responses import records

    return list(records(io.StringIO(text), tuple(p for p in path.split(".") if p)))


@pytest.mark.parametrize("chunk", [1, 2, 7, 1 << 16])
def test_records_of_a_stream(monkeypatch, chunk):
    from siltstone.sources import responses

    monkeypatch.setattr(responses, "CHUNK", chunk)
    assert streamed('[{"a": 1}, {"b": [2, "]"]} , 3 ]') == ['{"a": 1}', '{"b": [2, "]"]}', "3"]
    assert streamed(' {"a": 1}\n{"a": 22}\n') == ['{"a": 1}', '{"a": 22}']
    assert streamed("[ ]") == [] and streamed("") == [] and streamed("17") == [] and streamed("{}", "a") == []
    body = '{"x": {"list": [9]}, "data": {"n": 12345, "list": [{"k": "\\"é"}, {"k": 2}]}, "y": null}'
    assert streamed(body, "data.list") == ['{"k": "\\"é"}', '{"k": 2}']
    assert streamed(body, "data") == ['{"n": 12345, "list": [{"k": "\\"é"}, {"k": 2}]}']
    assert streamed(body, "data.n") == streamed(body, "data.n.z") == streamed(body, "nothing.at.all") == streamed("[1]", "a") == []
    for broken in ('[{"a": 1}', '[{"a": 1} 2]', '{"a" 1}', "[nul]"):
        with pytest.raises(ValueError):
            streamed(broken, "a" if broken.startswith("{") else "")


def test_a_large_page_is_read_record_by_record(spark, tmp_path):
    """60 MB of records in one file: no row and no buffer as large as the page."""
    from siltstone.sources import responses

    page = tmp_path / "pages" / "one.json"
    page.parent.mkdir()
    with page.open("w") as out:
        out.write('{"data": {"rows": [')
        for i in range(6000):
            out.write(("," if i else "") + json.dumps({"id": i, "text": f"é{i} " * 1500}, ensure_ascii=False))
        out.write("]}}")
    assert page.stat().st_size > 60_000_000
    largest = 0
    with page.open() as stream:
        text = responses.JsonText(stream)
        for _ in responses._below(text, ("data", "rows")):
            largest = max(largest, len(text.text))
    assert largest < 500_000
    spec = DatasetSpec("pages", "id long, text string", json_path="data.rows", streamed=True)
    found = LandedReader().read(spark, spec, str(tmp_path)).selectExpr("count(*)", "sum(id)", "max(length(text))").first()
    assert tuple(found) == (6000, 5999 * 3000, 1500 * 6)


def test_streamed_files_of_any_shape(spark, tmp_path):
    shapes = {"a.json": '[{"id": 1, "tags": ["x"]}]', "b.json": '{"id": 2}\n{"id": 3}', "c.json": "[]", "_SUCCESS": "", "d.json": ""}
    (tmp_path / "things").mkdir()
    for name, body in shapes.items():
        (tmp_path / "things" / name).write_text(body)
    spec = DatasetSpec("things", "id long, tags string", streamed=True)
    assert sorted(map(tuple, LandedReader().read(spark, spec, str(tmp_path)).collect())) == [(1, '["x"]'), (2, None), (3, None)]
    (tmp_path / "things" / "e.json").write_text('[{"id": 4}')
    with pytest.raises(Exception, match="malformed JSON|JSONDecodeError|Expecting"):
        LandedReader().read(spark, spec, str(tmp_path)).collect()


def test_small_files_share_a_task(spark, tmp_path):
    """A thousand pages are no thousand tasks; pages too large to share have tasks of their own."""
    from siltstone.sources.responses import OPEN_BYTES, TASK_BYTES, Files, dealt

    (tmp_path / "pages").mkdir()
    for i in range(1000):
        (tmp_path / "pages" / f"{i}.json").write_text(json.dumps({"data": {"rows": [{"id": i}, {"id": -i}]}}))
    spec = DatasetSpec("pages", "id long", json_path="data.rows", streamed=True)
    rows = LandedReader().read(spark, spec, str(tmp_path))
    assert rows.rdd.getNumPartitions() <= 16
    assert tuple(rows.selectExpr("count(*)", "sum(abs(id))").first()) == (2000, 999 * 1000)
    big = [("a", TASK_BYTES), ("b", 1), ("c", 1), ("d", TASK_BYTES * 3)]
    assert dealt(big, 1) == [Files(("a",)), Files(("b", "c")), Files(("d",))]
    assert [len(t.paths) for t in dealt([(str(i), 10) for i in range(8)], 4)] == [2, 2, 2, 2]
    assert sum(len(t.paths) for t in dealt([(str(i), OPEN_BYTES) for i in range(10**4)], 4)) == 10**4
    assert dealt([], 4) == [Files(())]
