"""The quadtree cover against the even-odd rule in plain Python, and the plan it gives."""

import math
import random

from test_spatial import inside

from voltatlas.operators.cover import clip_by_cover, cover_regions

POLYGONS = "region string, polygons array<array<array<struct<x:double,y:double>>>>"


def regions_of(spark, rings):
    rows = [(k, [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in own]]) for k, own in rings.items()]
    return spark.createDataFrame(rows, POLYGONS)


def test_cover_agrees_with_the_even_odd_rule(spark):
    rng = random.Random(3)
    rings = {"holed": [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(2, 2), (8, 2), (8, 8), (2, 8), (2, 2)]], "empty": [], "line": [[(1, 1), (2, 2), (1, 1)]]}
    for k in range(8):
        x, y, r, m = rng.uniform(-50, 50), rng.uniform(-40, 40), 10 ** rng.uniform(-2, 1.5), rng.choice([5, 40, 300])
        at = [(x + r * (0.4 + 0.6 * rng.random()) * math.cos(i / m * math.tau), y + r * (0.4 + 0.6 * rng.random()) * math.sin(i / m * math.tau)) for i in range(m)]
        at = [(round(a, 1), round(b, 1)) for a, b in at] if k % 4 == 0 else at  # edges on one another, vertices on points
        rings[f"star{k}"] = [[*at, at[0]]]
    points = [(i, rng.uniform(-60, 60), rng.uniform(-50, 50)) for i in range(600)] + [(1000 + i, round(rng.uniform(-2, 12)), round(rng.uniform(-2, 12))) for i in range(200)]
    points += [(2000 + i, *(c + rng.uniform(-0.5, 0.5) for c in rings[f"star{i % 8}"][0][0])) for i in range(400)] + [(3000, None, 1.0), (3001, 1e9, 1e9)]
    df = spark.createDataFrame([(i, x if x is None else float(x), float(y)) for i, x, y in points], "id long, lon double, lat double")
    expect = {(i, k) for i, x, y in points if x is not None for k, own in rings.items() if inside((x, y), own)}
    regions = regions_of(spark, rings)
    assert len(expect) > 100
    for leaf_edges in (4, 64):
        cover = cover_regions(regions, leaf_edges=leaf_edges)
        assert {(r.id, r.region) for r in clip_by_cover(df, cover).collect()} == expect
    # Without edges at all nothing is inside.
    assert cover_regions(regions.where("region = 'empty'")) is None and clip_by_cover(df, None).count() == 0


def test_cover_tells_inner_cells_and_joins_on_the_cell(spark):
    ring = [(20 + 10 * math.cos(i / 500 * math.tau), 50 + 10 * math.sin(i / 500 * math.tau)) for i in range(500)]
    cover = cover_regions(regions_of(spark, {"disc": [[*ring, ring[0]]]}))
    cells = cover.cells.collect()
    assert sum(r._edges is None for r in cells) > 20 and max(len(r._edges or []) for r in cells) <= 32
    points = spark.range(1000).selectExpr("id", "id % 90 as lon", "id % 80 as lat")
    text = clip_by_cover(points, cover)._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in text.splitlines() if "HashJoin" in line)
    assert "_key" in join and "NestedLoop" not in text
    # Points come from their scan to the join without an exchange.
    assert "Exchange" not in text[text.index("Generate explode") : text.index("Range (0, 1000")]
