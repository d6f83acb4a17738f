"""Hand-written values for the scalar functions."""

import datetime as dt
import math

from pyspark.sql import functions as F

from voltatlas.functions import points, responses, tags, timestamps, values

POINTS = [
    "POINT(19.9 50.1)", "POINT (19.9 50.1)", "point(19.9 50.1)", "POINT(19.9  50.1)", "POINT(1)", "POINT EMPTY", "POINT(a b)",
    "POINT(1 2 3)", "POINT(10 91)", "POINT(-181 1)", None, "POINT(1d 2f)", "POINT z ((1 2)",
]
HERE, NONE = (19.9, 50.1), (None, None)


def test_point_modes(column):
    got = {m: [tuple(r) for r in column(POINTS, lambda c: points.point_lon_lat(c, m))] for m in ("sql", "strict", "lenient")}
    assert got["sql"][:5] == [HERE, NONE, (None, 50.1), (19.9, None), (1.0, None)]
    assert got["sql"][7:11] == [(1.0, 2.0), (10.0, 91.0), (-181.0, 1.0), NONE]
    assert got["strict"][:4] == [HERE, NONE, HERE, HERE]
    assert got["strict"][4:] == [NONE, NONE, NONE, (1.0, 2.0), NONE, NONE, NONE, NONE, NONE]
    assert got["lenient"][:4] == [HERE, HERE, HERE, HERE]
    assert got["lenient"][7] == (1.0, 2.0)


def test_range_drops_nan(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (1.0, None), (180.0, 90.0)], "lon double, lat double")
    assert [r[0] for r in df.select(points.in_range("lon", "lat")).collect()] == [False, False, True]


def test_radius(column):
    got = column([None, 0.0, -1.0, 1.0, 2e7, 1e12], points.search_radius_m, "double")
    assert got == [3000, 3000, 3000, 1500, int(math.sqrt(2e7 / math.pi)), 10000]


T = dt.datetime(2026, 2, 2, 2, 40)


def test_timestamps(column):
    texts = {
        "1770000000": (T, T),
        "1770000000123": (T.replace(microsecond=123000),) * 2,
        "1770000000123456": (T.replace(microsecond=123456),) * 2,
        "1770000000123456789": (T.replace(microsecond=123457),) * 2,
        "2026-02-02T02:40:00": (T, T),
        "2026-02-02T04:40:00+02:00": (T, T),
        " 2026-02-02 02:40:00Z ": (T, T),
        "(seconds_since_epoch=1770000000, nanos=0)": (T, T),
        "seconds_since_epoch: 1770000000": (None, T),
        "seconds_since_epoch 1770000000": (None, T),
        "(1770000000)": (None, T),
        "2024-01-01": (None, None),
        "2024/01/05": (dt.datetime(2024, 1, 5),) * 2,
        "1e11": (None, None),
        "garbage": (None, None),
        "": (None, None),
        "-5": (dt.datetime(1969, 12, 31, 23, 59, 55),) * 2,
        "999999999999": (None, None),
        "100000000000": (dt.datetime(5138, 11, 16, 9, 46, 40),) * 2,
        None: (None, None),
    }
    for n, mode in enumerate(("numbers_first", "struct_first")):
        got = column(list(texts), lambda c: timestamps.coerce_ts(c, mode))
        assert dict(zip(texts, got)) == {k: v[n] for k, v in texts.items()}


def test_timestamp_columns_by_type(spark):
    df = spark.sql("select 1770000000 as a, double('NaN') as b, timestamp'2026-02-02 02:40:00' as c, "
                   "named_struct('seconds_since_epoch', 1770000000L, 'nanos', 0) as d")  # fmt: skip
    row = df.select(*[timestamps.coerce_ts_column(df, c).alias(c) for c in "abcd"]).first()
    assert tuple(row) == (T, None, T, T)


def test_clamp_and_repair(column):
    run = timestamps.ntz("2024-06-01 00:00:00")
    stamps = ["1999-12-31 00:00:00", "2101-01-01 00:00:00", None, "2024-06-01 20:00:00", "2024-06-03 00:00:00"]
    now = dt.datetime(2024, 6, 1)
    cast = lambda c: c.cast("timestamp_ntz")
    assert column(stamps, lambda c: timestamps.clamp_ts(cast(c), run))[:3] == [now] * 3
    assert column(stamps, lambda c: timestamps.clamp_ts(cast(c), None))[:3] == [None] * 3
    assert column(stamps, lambda c: timestamps.repair_ts(cast(c), run)) == [now, now, now, dt.datetime(2024, 6, 1, 20), now]
    assert column(stamps[3:4], lambda c: timestamps.ts_text(cast(c))) == ["2024-06-01 20:00:00.000000"]


def test_booleans(spark, column):
    texts = ["true", "T", " yes ", "1", "1.0", "0", "n", "2", "maybe", None]
    want = [True, True, True, True, None, False, False, None, None, None]
    assert column(texts, values.to_bool) == want
    assert column([1.0, 0.0, 2.0, float("nan"), None], lambda c: values.to_bool(c, numeric=True), "double") == [
        True, False, None, None, None,
    ]
    assert column([True, False, None], values.to_bool, "boolean") == [True, False, None]


def test_integers(column):
    assert column(["12", "12.9", "-3.7", " 15.2 ", "x", None, "1e3", "nan", "inf", "1d"], values.to_int) == [
        12, 12, -3, 15, None, None, 1000, None, None, None,
    ]
    assert column([12.9, -3.7, float("nan"), float("inf")], values.to_int, "double") == [12, -3, None, None]


def test_double_text_is_what_python_prints(column):
    xs = [0.0, 1.0, -50.1, 0.0005, -0.00012, 0.0001, 0.00001234, 1e-07, 179.99999999, 123456.75]
    assert column(xs, values.double_text, "double") == [str(x) for x in xs]


def test_request_key(spark):
    ddl = "road_feature_id string, road_osm_id long, request_point_lat double, request_point_lon double"
    rows = [("f", 1, 1.0, 2.0), ("", 7, 1.0, 2.0), (None, 0, 50.25, 0.0005), ("0", 3, 1.0, 2.0), (None, None, -1.5, 2.0)]
    df = spark.createDataFrame(rows, ddl)
    assert [r[0] for r in df.select(values.request_point_key(df)).collect()] == ["f", "7", "50.25,0.0005", "0", "-1.5,2.0"]


def test_outcomes(column):
    codes = [200, 400, 401, 403, 404, 418, 429, 500, 502, 503, 504, None]
    traffic = column(codes, lambda c: responses.outcome(c, "traffic"), "int")
    station = column(codes, lambda c: responses.outcome(c, "station"), "int")
    assert traffic == ["ok"] + ["permanent"] * 4 + ["other"] + ["retryable"] * 5 + ["other"]
    assert station == ["ok"] + ["permanent"] * 5 + ["retryable"] * 5 + ["other"]


def test_error_text_and_redaction(spark, column):
    assert column(["  abc ", "abcdef", None], lambda c: responses.error_text(c, 3)) == ["abc", "abc…", None]
    assert column(["x?key=1&a=2", "x?a=2&key=z#f", "x?monkey=1"], responses.redact_query) == [
        "x?key=***&a=2", "x?a=2&key=***#f", "x?monkey=1",
    ]
    df = spark.createDataFrame([({"key": "s", "point": "1,2"},)], "p map<string,string>")
    assert df.select(responses.redact_params("p")).first()[0] == {"key": "***", "point": "1,2"}


def test_tags(spark, column):
    bags = [{"a": 'say "x"', "b": None, "c": "1,2"}, {}, {"k": "=>"}]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bags)], "i int, m map<string,string>")
    rows = df.select("i", tags.tags_encode("m").alias("t")).select("i", "t", tags.tags_decode("t").alias("d")).orderBy("i").collect()
    assert rows[0].t == '"a"=>"say \\"x\\"","c"=>"1,2"'
    assert [r.d for r in rows] == [{"a": 'say "x"', "c": "1,2"}, {}, {"k": "=>"}]
    assert column(['"a"=>"1","a"=>"2"'], tags.tags_decode) == [{"a": "2"}]


def test_stable_ids(spark):
    one = spark.range(3).select(values.stable_event_id(F.lit("r"), "id").alias("e"))
    assert [r.e for r in one.collect()] == [r.e for r in one.collect()]
    assert one.distinct().count() == 3
    assert spark.range(3).select(values.random_event_id().alias("e")).distinct().count() == 3


def test_json_text(spark):
    df = spark.sql("select named_struct('a', 1, 'b', 'é') as s, array(1, 2) as l, 3.00BD as d, 3.5BD as e, 'x' as t")
    assert tuple(values.nested_to_json(df).first()) == ('{"a":1,"b":"é"}', "[1,2]", "3", "3.5", "x")


def test_common_date_texts_and_fallbacks(spark):
    from voltatlas.functions.timestamps import parse_iso
    from voltatlas.operators.quality import timestamp_fallbacks

    texts = ["Mon, 05 Feb 2024 10:00:00 GMT", "Feb 3 2024", "03-Feb-2024", "2024-02-03T04:05:06Z", "2024-13-45", "soon", None, "1999-01-01T00:00:00Z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [str(r[0]) for r in df.orderBy("i").select(parse_iso("t")).collect()]
    assert got == ["2024-02-05 10:00:00", "2024-02-03 00:00:00", "2024-02-03 00:00:00", "2024-02-03 04:05:06", "None", "None", "None", "1999-01-01 00:00:00"]
    assert [tuple(r) for r in timestamp_fallbacks(df, ["t"]).collect()] == [("t", 7, 3)]
