import math
import random
import struct

import pytest

from voltatlas.functions import geometry as G

SQUARE = [(0.0, 0.0), (1.5, 0.0), (1.0, 1.25), (0.0, 0.0)]


def wkb_polygon(rings, order="<"):
    out = struct.pack(order + "BII", 1 if order == "<" else 0, 3, len(rings))
    for ring in rings:
        out += struct.pack(order + "I", len(ring)) + b"".join(struct.pack(order + "2d", *p) for p in ring)
    return out


def wkb_multi(polygons, order="<"):
    head = struct.pack(order + "BII", 1 if order == "<" else 0, 6, len(polygons))
    return head + b"".join(wkb_polygon(p, order) for p in polygons)


def as_tuples(polygons):
    return [[[tuple(p) for p in ring] for ring in poly] for poly in polygons]


def test_geojson_to_wkt(column):
    texts = {
        '{"type":"Polygon","coordinates":[[[0, 0],[1.50,0],[1,1.25],[0,0]]]}': "POLYGON((0 0, 1.5 0, 1 1.25, 0 0))",
        '{"type":"Point","coordinates":[19.1,50.1,7]}': "POINT(19.1 50.1)",
        '{"type":"LineString","coordinates":[[-1,2],[3,4e-3]]}': None,
        '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}':
            "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))",
        '{"type":"MultiPoint","coordinates":[[1,2],[3,4]]}': "MULTIPOINT(1 2, 3 4)",
        '{"type":"Polygon","coordinates":[]}': "POLYGON EMPTY",
        '{"type":"Circle","coordinates":[1,2]}': None,
        "not json": None,
    }
    got = dict(zip(texts, column(list(texts), G.geojson_wkt)))
    line = got.pop('{"type":"LineString","coordinates":[[-1,2],[3,4e-3]]}')
    assert line.startswith("LINESTRING(-1 2, 3 ") and float(line[:-1].split()[-1]) == 0.004
    assert got == {k: v for k, v in texts.items() if k in got}


def test_wkb_both_ways(spark):
    rng = random.Random(5)
    numbers = [0.0, -1.1, 1e-300, 3962799.45, -2999718.85, math.pi, 2.0**-1000, 1e300, 0.1, 4.0, 0.49999999999999994]
    rings = [[(a, b) for a, b in zip(numbers, reversed(numbers))], SQUARE]
    many = [[[(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(5)]] for _ in range(40)]
    cases = [[rings], [rings, [SQUARE]], many]
    data = [bytearray(wkb_polygon(c[0], o)) if len(c) == 1 else bytearray(wkb_multi(c, o)) for c in cases for o in "<>"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(data)], "i int, b binary")
    out = df.withColumn("p", G.wkb_polygons("b")).withColumn("w", G.polygons_wkb("p")).orderBy("i").collect()
    for i, c in enumerate(c for c in cases for _ in "<>"):
        assert as_tuples(out[i].p) == c
        assert bytes(out[i].w) == (wkb_polygon(c[0], ">") if len(c) == 1 else wkb_multi(c, ">"))


def test_ewkb_srid(spark):
    body = wkb_polygon([SQUARE])
    ewkb = body[:1] + struct.pack("<II", 3 | 0x20000000, 3035) + body[5:]
    df = spark.createDataFrame([(bytearray(ewkb),)], "b binary")
    assert as_tuples(df.select(G.wkb_polygons("b")).first()[0]) == [[SQUARE]]


def forward_laea(lon, lat):
    """Forward projection, written from the published formulas."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    q = lambda p: (1 - e2) * (math.sin(p) / (1 - e2 * math.sin(p) ** 2)
                              - math.log((1 - e * math.sin(p)) / (1 + e * math.sin(p))) / (2 * e))
    p0, l0, p, l = map(math.radians, (52, 10, lat, lon))  # noqa: E741
    qp = q(math.pi / 2)
    b0, b = math.asin(q(p0) / qp), math.asin(q(p) / qp)
    rq = a * math.sqrt(qp / 2)
    d = a * math.cos(p0) / math.sqrt(1 - e2 * math.sin(p0) ** 2) / (rq * math.cos(b0))
    k = rq * math.sqrt(2 / (1 + math.sin(b0) * math.sin(b) + math.cos(b0) * math.cos(b) * math.cos(l - l0)))
    x = k * d * math.cos(b) * math.sin(l - l0)
    y = k / d * (math.cos(b0) * math.sin(b) - math.sin(b0) * math.cos(b) * math.cos(l - l0))
    return 4321000 + x, 3210000 + y


def test_laea_control_point_and_inverse(spark):
    rng = random.Random(7)
    places = [(5.0, 50.0), (10.0, 52.0)] + [(rng.uniform(-25, 45), rng.uniform(30, 71)) for _ in range(200)]
    rows = [(i, *forward_laea(*p)) for i, p in enumerate(places)]
    assert (round(rows[0][1], 2), round(rows[0][2], 2)) == (3962799.45, 2999718.85)
    df = spark.createDataFrame(rows, "i int, e double, n double")
    got = df.select("i", G.laea_to_lonlat("e", "n").alias("p")).orderBy("i").collect()
    for r, (lon, lat) in zip(got, places):
        assert abs(r.p.lon - lon) < 1e-7 and abs(r.p.lat - lat) < 1e-7


def test_linestring(column):
    ddl = "array<struct<latitude:string,longitude:string>>"
    good, bad = ("50", "19.5"), ("x", "1")
    cases = [[good, bad, ("51.25", "20"), None, ("95", "1"), (None, "1")], [good, bad], [], None]
    assert column(cases, G.linestring_wkt, ddl) == ["LINESTRING(19.5 50.0, 20.0 51.25)", None, None, None]


def test_ring_problems(column):
    text = '{{"type":"Polygon","coordinates":[{}]}}'
    cases = [text.format("[[0,0],[1,0],[1,1],[0,0]]"), text.format("[[0,0],[1,0],[0,0]]"),
             text.format("[[0,0],[1,0],[1,1],[2,2]]"), '{"type":"Point","coordinates":[1,2]}']
    assert column(cases, lambda c: G.ring_problem(G.geojson_polygons(c))) == [
        None, "ring under 4 points", "ring not closed", "no rings",
    ]


def test_reprojection_of_the_published_example(spark):
    # The worked example of EPSG guidance note 7-2 for this projection.
    p = G.laea_to_lonlat("3962799.45D", "2999718.85D")
    row = spark.range(1).select(p["lon"], p["lat"]).first()
    assert row[0] == pytest.approx(5.0, abs=1e-6) and row[1] == pytest.approx(50.0, abs=1e-6)
