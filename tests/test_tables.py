import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.functions.timestamps import ntz
from voltatlas.operators import quality as Q
from voltatlas.operators.align import align, evolve, lower_columns, union_all, union_levels
from voltatlas.operators.cube import decode_flat_index, encode_flat_index, tidy_cube, validate_tidy
from voltatlas.operators.totals import batch_totals
from voltatlas.plans.jobs import load_cube
from voltatlas.sinks.files import append_table, read_evolving, write_both, write_snapshot
from voltatlas.sources.cube import read_cube
from voltatlas.sources.tables import fetch_responses, latest_partition, read_batch_files, read_latest_snapshot

RUN = "2026-01-01 00:00:00"


def test_align(spark):
    df = spark.createDataFrame([("2026-02-02 02:40:00", "7", [1, 2], 9), ("bad", "8", None, 9)], "TS string, A string, L array<int>, extra int")
    out = align(df, "l string, a int, missing timestamp_ntz, ts timestamp_ntz")
    assert out.dtypes == [("l", "string"), ("a", "int"), ("missing", "timestamp_ntz"), ("ts", "timestamp_ntz")]
    assert [tuple(r) for r in out.collect()] == [("[1,2]", 7, None, dt.datetime(2026, 2, 2, 2, 40)), (None, 8, None, None)]
    with pytest.raises(ValueError, match="duplicate target"):
        align(df, T.StructType([T.StructField("a", T.StringType()), T.StructField("A", T.StringType())]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        align(spark.createDataFrame([("x",)], "a string"), "a int").collect()


def test_lower_and_union(spark):
    a, b = spark.createDataFrame([(1, "x")], "A int, B string"), spark.createDataFrame([("y", 2.0)], "b string, c double")
    both = union_all([lower_columns(a), b])
    assert [tuple(r) for r in both.orderBy("b").collect()] == [(1, "x", None), (None, "y", 2.0)]
    with pytest.raises(ValueError):
        lower_columns(spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "A"))
    assert {r.level for r in union_levels({"0": a, "1": a}).collect()} == {"0", "1"}
    with pytest.raises(ValueError):
        union_all([])


def test_evolve_is_additive():
    out = evolve("a int, b string", "B string, c double")
    assert out.simpleString() == "struct<a:int,b:string,c:double>"


def test_append_and_repair(spark, tmp_path):
    path, run = str(tmp_path / "t"), ntz(RUN)
    ddl = "id int, ts timestamp_ntz"
    old, late, ok = dt.datetime(1999, 1, 1), dt.datetime(2026, 1, 3), dt.datetime(2026, 1, 1, 20)
    append_table(spark.createDataFrame([(1, old), (2, late), (3, ok), (4, None)], ddl), path, ddl, run, ["ts"])
    append_table(spark.createDataFrame([], ddl), path, ddl, run, ["ts"])
    append_table(spark.createDataFrame([(5, ok, "n")], ddl + ", note string"), path, ddl + ", note string", run, ["ts"])
    now = dt.datetime(2026, 1, 1)
    rows = read_evolving(spark, path, ddl, "note string").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, now, None), (2, now, None), (3, ok, None), (4, now, None), (5, ok, "n")]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    for day in ("2026-01-02T00-00-00Z", "2026-01-01T00-00-00Z"):
        write_snapshot(spark.createDataFrame([(day,)], "d string"), path, day)
    assert [r.d for r in read_latest_snapshot(spark, path).collect()] == ["2026-01-02T00-00-00Z"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_snapshot(spark.createDataFrame([("x",)], "d string"), path, "2026-01-01T00-00-00Z")
    days = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "day int, v string")
    assert {r.v for r in latest_partition(days, "day").collect()} == {"b", "c"}


def test_batch_files(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    (tmp_path / "2.json").write_text("  ")
    (tmp_path / "3.json").write_text(json.dumps([{"a": 3, "b": "x"}], indent=1))
    paths = [str(tmp_path / f"{i}.json") for i in (1, 2, 3)]
    rows = read_batch_files(spark, paths, "a int, b string").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, None), (2, None), (3, "x")]
    with pytest.raises(ValueError):
        read_batch_files(spark, [], "a int")
    with pytest.raises(ValueError):
        read_batch_files(spark, paths[1:2], "a int")


def test_bad_batch_files_stop_or_stay(spark, tmp_path):
    for name, text in {"1": '[{"a": 1}]', "2": '[{"a": 2}, {"a"', "3": "no json", "4": '{"b": "only"}', "5": '{"a": 5} {"a": 6}', "6": "\n"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    with pytest.raises(Exception, match="cannot parse"):
        read_batch_files(spark, [str(tmp_path)], "a int, b string").collect()
    rows = read_batch_files(spark, [str(tmp_path)], "a int, b string", mode="quarantine").collect()
    assert sorted((r.a or 0, r.b or "", (r.bad or "")[:7]) for r in rows) == [
        (0, "", '[{"a": '), (0, "", "no json"), (0, "", '{"a": 5'), (0, "only", ""), (1, "", "")]
    assert read_batch_files(spark, [str(tmp_path / "4.json")], "a int").count() == 1


CUBE = {
    "id": ["freq", "geo", "time"], "size": [1, 2, 3],
    "dimension": {
        "freq": {"category": {"index": {"A": 0}}},
        "geo": {"category": {"index": {"PL": 1, "DE": 0}}},
        "time": {"category": {"index": {"2020": 0, "2021": 1, "2022": 2}}},
    },
    "value": {"0": 1.5, "4": None, "5": 7},
}


def test_cube_job(spark, tmp_path):
    src = tmp_path / "cube.json"
    src.write_text(json.dumps(CUBE, indent=1))
    target = load_cube(spark, str(src), str(tmp_path / "out"), "ds", ntz(RUN), "2026-01-01T00-00-00Z")
    df = spark.read.parquet(target)
    assert df.columns == ["dataset", "freq", "geo", "time", "value", "ingest_ts"]
    assert {tuple(r)[:5] for r in df.collect()} == {("ds", "A", "DE", "2020", 1.5), ("ds", "A", "PL", "2021", None), ("ds", "A", "PL", "2022", 7.0)}


def test_cube_without_values_fails(spark, tmp_path):
    src = tmp_path / "cube.json"
    src.write_text(json.dumps({**CUBE, "value": {}}))
    values, dims = read_cube(spark, str(src))
    with pytest.raises(Q.QualityError):
        validate_tidy(tidy_cube(values, dims, "ds", ntz(RUN)))


def test_cube_position_without_code_fails(spark, tmp_path):
    src = tmp_path / "cube.json"
    broken = json.loads(json.dumps(CUBE))
    del broken["dimension"]["time"]["category"]["index"]["2022"]
    src.write_text(json.dumps(broken))
    values, dims = read_cube(spark, str(src))
    with pytest.raises(Exception, match="no code for a position of time"):
        tidy_cube(values, dims, "ds", ntz(RUN)).collect()


def test_flat_index_roundtrip(spark):
    sizes = [2, 3, 4]
    placed = spark.range(24).withColumns({f"i{n}": p for n, p in enumerate(decode_flat_index("id", sizes))})
    assert tuple(placed.where("id = 17").first())[1:] == (1, 1, 1)
    assert placed.where(encode_flat_index([F.col(f"i{n}") for n in range(3)], sizes) != F.col("id")).isEmpty()


def test_gates(spark, tmp_path):
    df = spark.createDataFrame([("POINT(1 2)", 1), ("POINT(x)", 2), (None, 3)], "geom_wkt string, i int")
    good, bad = Q.split_bad_points(df, "geom_wkt")
    assert [r.i for r in good.collect()] == [1]
    assert {(r.i, r.reason) for r in bad.collect()} == {(2, "malformed"), (3, "missing")}
    with pytest.raises(Q.QualityError, match="POINT"):
        Q.require_some_points(df.where("i > 1"), "geom_wkt")
    with pytest.raises(Q.QualityError):
        Q.require_rows(df.where("false"), "x")
    with pytest.raises(Q.QualityError):
        Q.require_columns(df, ["nope"])
    with pytest.raises(Q.QualityError):
        Q.require_text_geometry(df.withColumn("b", F.lit(b"x")))
    with pytest.raises(Q.QualityError, match="projected"):
        Q.require_degrees(spark.createDataFrame([("POLYGON((4321000 3210000, 1 2))",)], "geom_wkt string"))
    assert Q.require_degrees(df) is df
    with pytest.raises(Q.QualityError):
        write_both(df.drop("geom_wkt"), df, str(tmp_path / "x"))


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in Q.output_profile(df).collect()] == [(1, "a", "int", 2, 2), (2, "b", "string", 2, 1)]


def test_file_profile(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    row = Q.file_profile(spark, str(tmp_path / "t")).first()
    assert (row.rows, row.files) == (100, 3) and row.bytes > 0


def test_totals(spark):
    df = spark.createDataFrame([(1, 200, "x"), (1, 403, None), (2, 500, None)], "batch_id int, http_status int, body string")
    assert {tuple(r) for r in batch_totals(df).collect()} == {(1, 2, 1, 1, 1), (2, 1, 1, 0, 0), (None, 3, 2, 1, 1)}


def test_fetch_hook_keeps_failures(spark):
    def fetch(key, params):
        return (200, None, "{}") if key == "a" else (None, "timed out", None)

    df = spark.createDataFrame([("a", "{}"), ("b", "{}")], "request_key string, params string")
    got = {tuple(r) for r in fetch_responses(df, fetch, 2).collect()}
    assert got == {("a", 200, None, "{}"), ("b", None, "timed out", None)}


def test_row_groups_of_layers(spark, tmp_path):
    import pyarrow.parquet as pq

    from voltatlas.sinks.files import ROWS_PER_GROUP, replace_table

    replace_table(spark.range(120_001).coalesce(1), str(tmp_path / "t"))
    (name,) = [p for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet"]
    meta = pq.ParquetFile(name).metadata
    sizes = [meta.row_group(k).num_rows for k in range(meta.num_row_groups)]
    assert sizes == [ROWS_PER_GROUP, ROWS_PER_GROUP, 20_001] and meta.row_group(0).column(0).compression == "ZSTD"


def test_publication(spark, tmp_path):
    """Parts become visible together; a run that fails leaves what was there; a reader keeps what it has opened."""
    from voltatlas.operators.quality import QualityError, require_rows
    from voltatlas.sinks.files import publish, read_published, versions

    path, one = str(tmp_path / "p"), spark.range(3)
    assert versions(spark, path) is None
    with pytest.raises(ValueError):
        read_published(spark, path, "a")
    assert publish(spark, path, {"a": one, "b": one}) == 1
    held = read_published(spark, path, "a")
    bad = spark.range(5).selectExpr("if(id = 4, raise_error('broken'), id) as id")
    with pytest.raises(Exception, match="broken"):
        publish(spark, path, {"a": spark.range(9), "b": bad})
    with pytest.raises(QualityError):
        publish(spark, path, {"a": spark.range(9), "b": one.limit(0)}, {"b": lambda df: require_rows(df, "b")})
    assert [read_published(spark, path, p).count() for p in "ab"] == [3, 3]
    assert publish(spark, path, {"a": spark.range(7), "b": spark.range(8)}) == 2
    assert [read_published(spark, path, p).count() for p in "ab"] == [7, 8] and held.count() == 3
    assert read_published(spark, path, "a", 1).count() == 3 and versions(spark, path).count() == 2
