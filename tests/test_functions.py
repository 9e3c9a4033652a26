import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from siltstone.functions import casts, exprs, jsonx


def one(spark, value, type_name, fn):
    return spark.createDataFrame([(value,)], f"c {type_name}").select(fn("c").alias("x")).first().x


@pytest.mark.parametrize(
    "text, want",
    [
        ("2006-03-24T22:30:00.000Z", dt.datetime(2006, 3, 24, 22, 30)),
        ("2020-01-01T10:00:00+12:00", dt.datetime(2020, 1, 1, 10)),
        ("2020-01-01T10:00:00-0330", dt.datetime(2020, 1, 1, 10)),
        ("2022-11-01T12:36Z", dt.datetime(2022, 11, 1, 12, 36)),
        ("2022-11-01T12:36+05:30", dt.datetime(2022, 11, 1, 12, 36)),
        ("2022-11-01T12:36+05", dt.datetime(2022, 11, 1, 12, 36)),
        (" 2022-11-01 12:36:01.5 ", dt.datetime(2022, 11, 1, 12, 36, 1, 500000)),
        ("2022-11-01", dt.datetime(2022, 11, 1)),
        (None, None),
    ],
)
def test_text_to_timestamp_drops_the_zone(spark, text, want):
    assert one(spark, text, "string", casts.to_ntz) == want


def test_text_that_is_no_timestamp_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "soon", "string", casts.to_ntz)


@pytest.mark.parametrize(
    "text, want",
    [("true", True), ("t", True), ("on", True), ("ON ", True), ("off", False), ("no", False), ("0", False), (None, None)],
)
def test_text_to_boolean(spark, text, want):
    assert one(spark, text, "string", casts.to_bool) is want


def test_boolean_stays_boolean(spark):
    assert one(spark, True, "boolean", casts.to_bool) is True
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "maybe", "string", casts.to_bool)


@pytest.mark.parametrize("value, away, even", [(0.5, 1, 0), (1.5, 2, 2), (2.5, 3, 2), (-0.5, -1, 0), (-1.5, -2, -2), (7.49, 7, 7)])
def test_rounding_to_integer(spark, value, away, even):
    assert one(spark, value, "double", casts.to_int) == away
    assert one(spark, value, "double", casts.double_to_int) == even


@pytest.mark.parametrize("value, kind", [("1e-19", "string"), (1e-19, "double"), (1.23456789e-12, "double")])
def test_digits_that_would_be_lost_fail(spark, value, kind):
    with pytest.raises(Exception, match="more digits than"):
        one(spark, value, kind, casts.to_decimal)


def test_decimal_text_and_day(spark):
    assert str(one(spark, 12.34567, "double", casts.to_decimal)) == "12.345670000000000000"
    assert str(one(spark, "0.00004", "string", casts.to_decimal)) == "0.000040000000000000"
    assert one(spark, 12, "long", casts.to_text) == "12"
    assert one(spark, dt.datetime(2022, 1, 2, 23), "timestamp_ntz", casts.to_day) == dt.date(2022, 1, 2)


@pytest.mark.parametrize(
    "text, want",
    [
        ('[{"k": 5}, {"k": 6}]', "5"),
        ('[{"k": "x"}]', "x"),
        ('[{"k": true}]', "true"),
        ('[{"k": {"a": 1}}]', '{"a":1}'),
        ('[{"k": null}]', None),
        ('[{"j": 5}]', None),
        ("[]", None),
        ("[1]", None),
        ('{"k": 5}', None),
        ("null", None),
        (None, None),
        ('[{"k": 1, "k": 2}]', "2"),
    ],
)
def test_key_of_first_element(spark, text, want):
    assert one(spark, text, "string", lambda c: jsonx.first_element_key(c, "k")) == want


@pytest.mark.parametrize("text, want", [('["a", "b"]', "a"), ("[]", None), (None, None), ('[{"k": 1}]', '{"k":1}')])
def test_first_element(spark, text, want):
    assert one(spark, text, "string", jsonx.first_element) == want


@pytest.mark.parametrize("fn", [jsonx.first_element, jsonx.elements_text])
def test_malformed_json_fails(spark, fn):
    with pytest.raises(Exception, match="MALFORMED"):
        one(spark, '["a"', "string", fn)


def test_unnesting(spark):
    df = spark.createDataFrame([(1, '["a", "b", "a"]'), (2, "[]"), (3, None), (4, "[null, 7]")], "id int, j string")
    got = sorted(jsonx.explode_text(df, "j", "e", "id").collect(), key=str)
    assert [tuple(r) for r in got] == [(1, "a"), (1, "a"), (1, "b"), (4, "7"), (4, None)]
    with pytest.raises(Exception, match="MALFORMED"):
        jsonx.explode_text(spark.createDataFrame([('{"a": 1}',)], "j string"), "j", "e").collect()


def test_validity(spark):
    df = spark.createDataFrame([('{"a":1}',), ("[1",), (None,), ("7",)], "j string")
    assert [r[0] for r in df.select(jsonx.is_valid_json("j")).collect()] == [True, False, True, True]


def test_complex_columns_become_json_text(spark):
    df = spark.sql(
        "SELECT 1 AS id, array('x', null) AS l, named_struct('a', 1, 'b', cast(null AS int)) AS s, "
        "map('k', 1) AS m, cast(null AS array<int>) AS n, named_struct('z', '名') AS `dotted.name`"
    )
    out = jsonx.encode_complex_columns(df)
    assert tuple(out.first()) == (1, '["x",null]', '{"a":1,"b":null}', '{"k":1}', None, '{"z":"名"}')
    assert out.columns == df.columns


@pytest.mark.parametrize("cost, mass, zero, null", [(10.0, 4.0, 2.5, 2.5), (10.0, 0.0, 0.0, None), (10.0, None, 0.0, None), (10.0, -1.0, 0.0, None), (None, 2.0, None, None)])
def test_guarded_ratios(spark, cost, mass, zero, null):
    df = spark.createDataFrame([(cost, mass)], "c double, m double")
    got = df.select(exprs.ratio_else_zero("c", "m").alias("z"), exprs.ratio_else_null("c", "m").alias("n")).first()
    assert (got.z, got.n) == (zero, null)


@pytest.mark.parametrize(
    "speed, want",
    [(None, "LOW RISK"), (500.0, "LOW RISK"), (500.1, "MEDIUM RISK"), (1000.0, "MEDIUM RISK"), (1000.1, "HIGH RISK")],
)
def test_risk_bands_are_strict(spark, speed, want):
    assert one(spark, speed, "double", exprs.risk_band) == want


def test_pair_key(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "b")], "l string, r string")
    assert [r[0] for r in df.select(exprs.pair_key("l", "r")).collect()] == ["a-b", "a-NO_EVENT", None]


def test_surrogate_key(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    want = hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()
    assert df.select(exprs.surrogate_key("a", "b")).first()[0] == want


def test_time_arithmetic(spark):
    a, b = dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1, 1, 30)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(exprs.epoch_micros("a"), exprs.hours_between("a", "b"), exprs.hours_between("b", "a")).first()
    assert got[0] == -1
    assert got[1] == got[2] == pytest.approx(1.5 + 1 / 3.6e9)


def test_lookback_window(spark):
    assert exprs.lookback_window(dt.date(2022, 12, 31)) == ("2022-11-01", "2022-12-31")
    days = [dt.datetime(2022, 10, 31, 23, 59), dt.datetime(2022, 11, 1), dt.datetime(2022, 12, 31, 23, 59), dt.datetime(2023, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    assert df.where(exprs.within_days("t", "2022-11-01", "2022-12-31")).count() == 2


def test_months(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 31),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(exprs.month_of("t")).collect()] == ["2022-01", "none"]


def test_null_aware_defaults(spark):
    assert one(spark, None, "long", exprs.zero_if_null) == 0
    assert one(spark, 3, "long", exprs.zero_if_null) == 3


def test_ordinary_small_doubles_are_taken(spark):
    assert str(one(spark, 1.2345678901234567e-05, "double", casts.to_decimal)) == "0.000012345678901235"
    assert str(one(spark, 0.1 + 0.2, "double", casts.to_decimal)).startswith("0.30000000000000004")


def test_fields_of_the_first_element(spark):
    from siltstone.functions.jsonx import first_fields

    texts = ['[{"k": 1.5, "m": [1]}, {"k": 2}]', "[]", '{"k": 1}', "[3]", '[{"k": null}]', None, '[{"m": {"x": "y"}}]', "7"]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "i int, j string, `a.b` string")
    out = first_fields(df, "j", key="k", _m="m")
    assert out.columns == ["i", "j", "a.b", "key", "_m"]
    got = {r.i: (r.key, r._m) for r in out.collect()}
    assert got == {0: ("1.5", "[1]"), 1: (None, None), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, '{"x":"y"}'), 7: (None, None)}
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        first_fields(df.select(F.lit("[{").alias("j")), "j", key="k").collect()
