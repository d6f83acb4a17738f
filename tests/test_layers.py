import gzip
import json
import struct

import pytest
from pyspark.sql import functions as F

from voltatlas.functions import geometry as G
from voltatlas.operators.layers import admin_features, admin_layer, features_layer, geometry_layer, grid_text, text_layer
from voltatlas.operators.quality import QualityError
from voltatlas.plans.jobs import load_boundaries, load_census_grid, load_map_layer, load_municipalities
from voltatlas.sources.features import level_of, read_census_grid, read_geojson_seq, record_separated
from voltatlas.specs import LAYERS, MAP_DATASETS

POLY = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
LINE = {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}


def feature(geometry=POLY, **props):
    return {"type": "Feature", "properties": props, "geometry": geometry}


ADMIN = [
    feature(osm_id=1, osm_type="relation", type="boundary", name="A", boundary="administrative", admin_level="4",
            note='say "hi"', pop="1,000", gone=None),
    feature(**{"@id": 2, "@type": "relation"}, boundary="administrative", admin_level=2),
    feature(id="3", osm_type="relation", boundary="maritime", type="multipolygon", admin_level="6"),
    feature(osm_id=4, osm_type="way", boundary="administrative", admin_level="4"),
    feature(osm_id=5, osm_type="relation", boundary="administrative", admin_level="8"),
    feature(LINE, osm_id=6, osm_type="relation", boundary="administrative", admin_level="4"),
    feature(osm_type="relation", boundary="administrative", admin_level="4"),
    feature(osm_id=8, osm_type="relation", boundary="maritime", admin_level="4"),
]


def write_seq(path, features, rs=True):
    sep = "\x1e" if rs else ""
    path.write_text("".join(f"{sep}{json.dumps(f, ensure_ascii=False)}\n" for f in features) + "\n", encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("rs", [True, False])
def test_sequence_scan(spark, tmp_path, rs):
    path = write_seq(tmp_path / "a.geojsonseq", ADMIN, rs)
    assert len(record_separated(spark, path)) == rs
    rows = read_geojson_seq(spark, path).collect()
    assert len(rows) == len(ADMIN)
    assert rows[0].properties["note"] == 'say "hi"'
    assert json.loads(rows[5].geometry) == LINE


def test_record_over_several_lines(spark, tmp_path):
    path = tmp_path / "a.seq"
    path.write_text("".join("\x1e" + json.dumps(f, indent=1) + "\n" for f in ADMIN))
    assert read_geojson_seq(spark, str(path)).count() == len(ADMIN)


def test_bad_record(spark, tmp_path):
    path = tmp_path / "a.seq"
    path.write_text(json.dumps(ADMIN[0]) + "\n\n{broken" + "x" * 400 + "\n")
    with pytest.raises(Exception, match=r"cannot parse record: \{brokenx{190,193}(?!x)"):
        read_geojson_seq(spark, str(path)).collect()
    rows = read_geojson_seq(spark, str(path), mode="quarantine").collect()
    assert [r.bad for r in rows] == [False, True]


def test_admin(spark, tmp_path):
    features = read_geojson_seq(spark, write_seq(tmp_path / "a.seq", ADMIN))
    rows = {r.osm_id: r for r in admin_features(features).collect()}
    assert sorted(rows) == ["1", "2", "3"]
    assert rows["1"].other_tags == '"note"=>"say \\"hi\\"","pop"=>"1,000"'
    assert (rows["2"].name, rows["2"].osm_type, rows["2"].other_tags) == (None, "relation", "")
    assert {r.osm_id for r in admin_features(features, []).collect()} == {"1", "2", "3", "5"}
    layer = admin_layer(features, ["4"])
    assert layer.columns == [*LAYERS["admin"].columns, "geom_wkt"]
    assert layer.first().geom_wkt == "POLYGON((0 0, 1 0, 1 1, 0 0))"
    with pytest.raises(QualityError):
        admin_layer(features, ["11"])


def test_projection_sizes():
    sizes = {n: len(LAYERS[n].columns) for n in MAP_DATASETS}
    assert sizes == {"admin": 6, "roads": 9, "charging": 4, "poi_points": 9, "poi_polygons": 23, "pt_points": 9,
                     "pt_lines": 10, "buildings_activity": 23}
    assert [len(LAYERS[n].columns) for n in ("nuts", "lau", "census_grid")] == [4, 5, 29]


def test_map_layer_job(spark, tmp_path):
    roads = [feature(LINE, osm_id="1", highway="primary", z_order=3), feature(LINE, osm_id="2")]
    src, out = write_seq(tmp_path / "r.seq", roads), str(tmp_path / "out")
    for dt in ("2026-01-01", "2026-01-02", "2026-01-02"):
        load_map_layer(spark, src, out, "poland", "mazowieckie", "roads", dt)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 2 and {str(r.dt) for r in rows} == {"2026-01-01", "2026-01-02"}
    assert (rows[0].osm_id, rows[0].z_order, rows[0].geom_wkt) == ("1", 3, "LINESTRING(1 2, 3 4)")
    with pytest.raises(QualityError):
        load_map_layer(spark, write_seq(tmp_path / "e.seq", roads[1:]), out, "poland", "mazowieckie", "roads", "2026-01-03")


def test_geometry_output(spark, tmp_path):
    features = read_geojson_seq(spark, write_seq(tmp_path / "a.seq", ADMIN[:2]))
    from voltatlas.sources.features import properties_to_columns

    df = geometry_layer(properties_to_columns(features, LAYERS["poi_polygons"], ["geometry"]), "poi_polygons")
    row = df.first()
    assert row.crs == 4326 and bytes(row.geom_wkb)[:5] == b"\x00\x00\x00\x00\x03"


def _wkb(code: int, body: bytes) -> bytes:
    return struct.pack(">bI", 0, code) + body


def test_wkb_of_all_types(spark):
    pairs = lambda *ps: struct.pack(">I", len(ps)) + b"".join(struct.pack(">dd", *p) for p in ps)
    ring = [[0, 0], [-1.5, 0], [1e-7, 52.1], [0, 0]]
    polygon = struct.pack(">I", 1) + pairs(*ring)
    shapes = [
        ("Point", [21.0123456, -52.5, 7], _wkb(1, struct.pack(">dd", 21.0123456, -52.5))),
        ("LineString", [[0, 0], [1.1, 2.2]], _wkb(2, pairs((0, 0), (1.1, 2.2)))),
        ("Polygon", [ring], _wkb(3, polygon)),
        ("MultiPoint", [[1, 2], [3, 4]], _wkb(4, struct.pack(">I", 2) + b"".join(_wkb(1, struct.pack(">dd", *p)) for p in [(1, 2), (3, 4)]))),
        ("MultiLineString", [[[0, 0], [1, 1]]], _wkb(5, struct.pack(">I", 1) + _wkb(2, pairs((0, 0), (1, 1))))),
        ("MultiPolygon", [[ring]], _wkb(6, struct.pack(">I", 1) + _wkb(3, polygon))),
        ("GeometryCollection", [], None), ("Point", [], None), ("LineString", [[0, None]], None),
    ]
    df = spark.createDataFrame([(i, json.dumps({"type": t, "coordinates": c})) for i, (t, c, _) in enumerate(shapes)], "i int, g string")
    rows = df.select("i", G.geojson_wkb("g").alias("w"), G.geojson_wkb("g", promote=True).alias("m")).orderBy("i").collect()
    assert [r.w and bytes(r.w) for r in rows] == [w for _, _, w in shapes]
    assert bytes(rows[2].m) == shapes[5][2] and bytes(rows[0].m) == shapes[0][2]


def test_unreadable_geometry_is_an_error(spark):
    odd = spark.createDataFrame([("1", '{"type":"GeometryCollection","geometries":[]}')], "osm_id string, geometry string")
    for layer in (text_layer, geometry_layer):
        with pytest.raises(Exception, match="cannot convert geometry"):
            layer(odd, "poi_points").collect()
    none = odd.withColumn("geometry", F.lit(None).cast("string"))
    assert text_layer(none, "poi_points").first().geom_wkt is None and geometry_layer(none, "poi_points").first().geom_wkb is None


def test_boundary_features_are_parsed_by_many_tasks(spark, tmp_path):
    from voltatlas.sources.features import read_feature_collection

    doc = {"type": "FeatureCollection", "features": [feature(NUTS_ID=f"N{i}") for i in range(200)]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    rows = read_feature_collection(spark, str(tmp_path / "a.json"))
    assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_features_layer_fills_missing_attributes(spark, tmp_path):
    features = read_geojson_seq(spark, write_seq(tmp_path / "a.seq", [feature(osm_id=1, shop="yes")]))
    row = features_layer(features, "poi_polygons").first()
    assert (row.osm_id, row.shop, row.craft) == ("1", "yes", None)


def test_boundaries_job(spark, tmp_path):
    paths = []
    for level in (0, 1):
        doc = {"type": "FeatureCollection", "features": [
            feature(NUTS_ID=f"PL{level}{i}", CNTR_CODE="PL", NAME_LATN="N", LEVL_CODE=level) for i in range(level + 1)]}
        p = tmp_path / f"nuts_rg_20m_2024_4326_level={level}.geojson{'.gz' if level else ''}"
        p.write_bytes(gzip.compress(json.dumps(doc).encode()) if level else json.dumps(doc, indent=1).encode())
        paths.append(str(p))
    load_boundaries(spark, paths, str(tmp_path / "out"), 2024, "20m", 4326)
    rows = spark.read.parquet(str(tmp_path / "out" / "year=2024" / "scale=20m" / "crs=4326")).collect()
    assert sorted((r.NUTS_ID, r.LEVL_CODE, str(r.level)) for r in rows) == [("PL00", 0, "0"), ("PL10", 1, "1"), ("PL11", 1, "1")]
    assert rows[0].geom_wkt.startswith("POLYGON((")


def test_level_names(column):
    names = ["x_level=2.parquet", "NUTS_RG_20M_2024_4326_LEVL_3.geojson", "other.json"]
    assert column(names, level_of) == ["2", "3", "unknown"]


def test_municipalities_job(spark, tmp_path):
    lau = spark.createDataFrame([("PL_1", "PL", "1", "A", 2, json.dumps(POLY))],
                                "GISCO_ID string, CNTR_CODE string, LAU_ID string, LAU_NAME string, DGURBA int, geometry string")
    for _ in range(2):
        load_municipalities(lau, str(tmp_path / "lau"))
    assert spark.read.parquet(str(tmp_path / "lau")).count() == 1
    assert text_layer(lau, "lau").columns[-1] == "geom_wkt"


def test_census_grid_job(spark, tmp_path):
    x, y = 4321000.0, 3210000.0
    ring = [(x, y), (x + 1000, y), (x + 1000, y + 1000), (x, y + 1000), (x, y)]
    wkb = struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<2d", *p) for p in ring)
    src = str(tmp_path / "grid")
    spark.createDataFrame([("g", 5, 1, bytearray(wkb))], "GRD_ID string, T long, POPULATED int, geom binary").write.parquet(src)
    load_census_grid(spark, src, str(tmp_path / "out"))
    text = spark.read.parquet(str(tmp_path / "out" / "text")).first()
    assert text.geom_wkt.startswith("POLYGON((10 52, 10.01") and text["T"] == 5 and text["M"] is None
    geo = spark.read.parquet(str(tmp_path / "out" / "geometry")).first()
    assert geo.crs == 3035 and bytes(geo.geom) == wkb
    assert len(grid_text(read_census_grid(spark, src)).columns) == 30


def test_charging_modes(spark):
    df = spark.createDataFrame(
        [("1", '"amenity"=>"charging_station"'), ("2", '"note"=>"no charging_station here"'), ("3", '"charging"=>"yes"')],
        "osm_id string, other_tags string",
    )
    spec = LAYERS["charging"]
    assert [r.osm_id for r in df.where(spec.predicate("text")).orderBy("osm_id").collect()] == ["1", "2"]
    assert [r.osm_id for r in df.where(spec.predicate("tags")).orderBy("osm_id").collect()] == ["1", "3"]
    assert LAYERS["poi_points"].predicate() is None


def test_features_of_a_small_file_are_made_on_all_cores(spark, tmp_path):
    from voltatlas.queries.formats import _features

    rows = spark.range(1, 41).selectExpr("id as c_custkey", "'c' || id as c_name", "cast(id % 25 as int) as c_nationkey")
    rows.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    features = _features(spark, str(tmp_path))
    assert features.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    assert features.selectExpr("count(distinct properties['osm_id'])").first()[0] == 40
