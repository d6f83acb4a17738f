"""Radius join and clip against brute force in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from voltatlas.operators.spatial import RadiusJoin, clip_to_regions, open_grid
from voltatlas.session import scratch_dir

R = 6371008.8


def dist(a, b):
    la1, lo1, la2, lo2 = map(math.radians, (*a, *b))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(min(1.0, h)))


def brute(cands, stations, k):
    out = set()
    for c, lat, lon, r in cands:
        near = sorted((d, s) for s, a, b in stations if (d := dist((lat, lon), (a, b))) <= r)
        out |= {(c, s, i + 1) for i, (_, s) in enumerate(near[:k] if k else near)}
    return out


def run(spark, cands, stations, **kw):
    c = spark.createDataFrame(cands, "c long, lat double, lon double, radius_m int")
    s = spark.createDataFrame(stations, "s long, station_lat double, station_lon double")
    rows = RadiusJoin("c", "s", **kw).run(c, s).select("c", "s", "rank_by_dist").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def world(rng, n, centre, spread):
    return [(i, max(-90.0, min(90.0, centre[0] + rng.gauss(0, spread))),
             (centre[1] + rng.gauss(0, spread * 2) + 180) % 360 - 180) for i in range(n)]


CENTRES = [(50.0, 19.5), (0.02, 179.98), (89.97, 10.0), (-89.99, -179.9), (70.0, -180.0)]


@pytest.mark.parametrize("leaf", [1024, 3])
def test_radius_join_equals_brute_force(spark, leaf):
    """Mid-latitude, equator at the date line, both poles, the date line again."""
    stations, cands = [], []
    for n, centre in enumerate(CENTRES):
        rng = random.Random(n)
        stations += [(i + 1000 * n, a, b) for i, a, b in world(rng, 100, centre, 0.05)]
        cands += [(i + 1000 * n, a, b, rng.choice([1500, 3000, 10000])) for i, a, b in world(rng, 35, centre, 0.06)]
    assert run(spark, cands, stations, leaf_rows=leaf) == brute(cands, stations, 10)


def test_no_limit(spark):
    rng = random.Random(3)
    stations = world(rng, 60, (50.0, 19.5), 0.03)
    cands = [(i, a, b, 5000) for i, a, b in world(rng, 20, (50.0, 19.5), 0.03)]
    assert run(spark, cands, stations, limit=None) == brute(cands, stations, None)


def test_a_third_of_all_stations_on_one_spot(spark):
    rng = random.Random(11)
    stations = world(rng, 200, (50.0, 19.5), 0.02)
    stations += [(1000 + i, 50.0, 19.5) for i in range(100)]
    cands = [(i, a, b, 6000) for i, a, b in world(rng, 30, (50.0, 19.5), 0.02)] + [(99, 50.0, 19.5, 3000)]
    assert run(spark, cands, stations, leaf_rows=8) == brute(cands, stations, 10)


def test_crowd_next_to_a_lonely_candidate(spark):
    """The candidate's own cell is thin; the crowd sits in the next one."""
    rng = random.Random(13)
    stations = [(i, 50.05 + rng.random() * 0.002, 19.55 + rng.random() * 0.002) for i in range(300)]
    stations += [(1000 + i, 50.0 + i * 0.004, 19.5) for i in range(12)]
    cands = [(1, 50.0, 19.5, 10000), (2, 50.05, 19.549, 10000), (3, 50.2, 19.5, 10000), (4, 10.0, 19.5, 10000)]
    assert run(spark, cands, stations, leaf_rows=4) == brute(cands, stations, 10)


def test_crowded_path_looks_at_few_pairs(spark):
    """4,000 stations in one base cell: a candidate meets a small part of them."""
    rng = random.Random(17)
    stations = [(i, 50.01 + rng.random() * 0.08, 19.51 + rng.random() * 0.08) for i in range(4000)]
    cands = [(i, 50.05, 19.55 + i * 0.0001, 10000) for i in range(20)]
    c = spark.createDataFrame(cands, "c long, lat double, lon double, radius_m int")
    s = spark.createDataFrame(stations, "s long, station_lat double, station_lon double")
    join = RadiusJoin("c", "s", leaf_rows=64)
    from voltatlas.operators import spatial as S

    grid = join.store(s, scratch_dir(spark, "grid"))
    spread = S._covering_cells(c, F.col("lat"), F.col("lon"), F.col("radius_m").cast("double"))
    pairs = join._pairs(spread, grid).count()
    assert pairs < 20 * 1500
    assert run(spark, cands, stations, leaf_rows=64) == brute(cands, stations, 10)


def test_candidates_of_a_place_share_its_list(spark):
    """300 candidates side by side are paired with what may rank, and not with the stations of their cells."""
    from voltatlas.operators import spatial as S

    rng = random.Random(37)
    stations = [(i, 50.01 + rng.random() * 0.08, 19.51 + rng.random() * 0.08) for i in range(1500)]
    cands = [(i, 50.05 + rng.random() * 0.001, 19.55 + rng.random() * 0.001, 3000) for i in range(300)]
    c = spark.createDataFrame(cands, "c long, lat double, lon double, radius_m int")
    s = spark.createDataFrame(stations, "s long, station_lat double, station_lon double")
    join = RadiusJoin("c", "s")
    spread = S._covering_cells(c, F.col("lat"), F.col("lon"), F.col("radius_m").cast("double"))
    rows = join._pairs(spread, join.store(s, scratch_dir(spark, "grid"))).select("c", "s").collect()
    assert len(rows) <= spread.count() * 12
    pairs = {tuple(r) for r in rows}
    assert {(x, y) for x, y, _ in brute(cands, stations, 10)} <= pairs


@pytest.mark.parametrize("leaf_rows", [1024, 4])
def test_stored_grid(spark, leaf_rows):
    """One grid for two limits and two tables; stations without a place are left out; no shuffle of stations."""
    rng = random.Random(29)
    stations = world(rng, 400, (50, 19.5), 0.2) + [(1000 + i, 50.0, 19.5) for i in range(60)]
    s = spark.createDataFrame([*stations, (-1, None, 19.5), (-2, 50.0, None)], "s long, station_lat double, station_lon double")
    path = scratch_dir(spark, "grid")
    RadiusJoin("c", "s", leaf_rows=leaf_rows).store(s, path, 8)
    for k, seed in ((10, 1), (3, 2)):
        cands = [(i, lat, lon, 9000) for i, lat, lon in world(random.Random(seed), 30, (50, 19.5), 0.2)]
        c = spark.createDataFrame(cands, "c long, lat double, lon double, radius_m int")
        got = RadiusJoin("c", "s", limit=k).run(c, open_grid(spark, path))
        assert {(r.c, r.s, r.rank_by_dist) for r in got.collect()} == brute(cands, stations, k)
    with pytest.raises(ValueError):
        RadiusJoin("c", "s", limit=11).run(c, open_grid(spark, path))


def test_stations_of_a_grid_are_not_shuffled(spark):
    stations = spark.range(5000).selectExpr("id as s", "50 + id / 10000 as station_lat", "19 + (id % 700) / 900 as station_lon")
    cands = spark.range(50).selectExpr("id as c", "50 + id / 100 as lat", "19 + id / 70 as lon", "3000 as radius_m")
    join, was = RadiusJoin("c", "s"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    grid = join.store(stations, scratch_dir(spark, "grid"), 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = join.run(cands, grid)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    lines = plan.splitlines()
    at = next(k for k, x in enumerate(lines) if "Bucketed: true" in x)
    depth = lines[at].index("FileScan")
    above = []
    for line in reversed(lines[:at]):
        here = next((k for k, ch in enumerate(line) if ch.isalpha()), 0)
        if here < depth:
            above, depth = [*above, line], here
        if "Join" in line:
            break
    assert not any("Exchange" in x for x in above)


def inside(p, rings):
    x, y = p
    n = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                n += 1
    return n % 2 == 1


@pytest.mark.parametrize("per_array", [2048, 2])
def test_clip(spark, per_array):
    rng = random.Random(23)
    circle = [(10 + math.cos(i / 50 * math.tau) * 2, 45 + math.sin(i / 50 * math.tau) * 2) for i in range(50)]
    circle.append(circle[0])
    hole = [(9.5, 44.5), (10.5, 44.5), (10.5, 45.5), (9.5, 45.5), (9.5, 44.5)]
    notch = [(8.0, 44.0), (13.0, 44.0), (13.0, 47.0), (10.5, 44.7), (8.0, 47.0), (8.0, 44.0)]
    regions = {"circle": [circle, hole], "notch": [notch]}
    pts = [(i, 7 + rng.random() * 7, 42 + rng.random() * 6) for i in range(400)]
    r = spark.createDataFrame(
        [(k, [[[{"x": x, "y": y} for x, y in ring] for ring in rings]]) for k, rings in regions.items()],
        "region string, polygons array<array<array<struct<x:double,y:double>>>>",
    )
    p = spark.createDataFrame(pts, "id long, lon double, lat double")
    got = {(x.id, x.region) for x in clip_to_regions(p, r, "id", edges_per_array=per_array).collect()}
    assert got == {(i, k) for i, x, y in pts for k, rings in regions.items() if inside((x, y), rings)}


def test_cells_out_of_reach_are_not_shuffled(spark):
    """Cells beyond the radius, and parts beyond the bound of the level above, go before the window's shuffle."""
    cells = spark.range(5).selectExpr("id as c", "50.05 as lat", "19.5 as lon", "1500 as radius_m", "((1400 + id) << 32) + 1254 as _cell", "50L as count", "0 as _level")
    kept = RadiusJoin("c", "s")._drop_hopeless(cells)
    lines = kept._jdf.queryExecution().executedPlan().toString().splitlines()
    window = max(k for k, x in enumerate(lines) if "Window" in x)
    assert any("Filter" in x and "<=" in x for x in lines[window:])
    assert "_bound" in kept.columns
