"""Rings that cross themselves, against every pair of edges."""

import random

from voltatlas.operators.rings import self_crossings


def crossings(ring):
    n = len(ring) - 1
    side = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    found = 0
    for i in range(n):
        for j in range(i + 2, n - (i == 0)):
            a, b, c, d = ring[i], ring[i + 1], ring[j], ring[j + 1]
            found += side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0
    return found


def test_self_crossings(spark):
    rng = random.Random(3)
    rings = {1: [(0, 0), (4, 0), (4, 4), (0, 4)], 2: [(0, 0), (4, 4), (4, 0), (0, 4)], 3: [(0, 0), (0, 0), (0, 0)], 4: [(0, 0), (2, 0), (1, 0), (3, 0)], 5: []}
    for k in range(10, 30):
        rings[k] = [(rng.randrange(-50, 50), rng.randrange(-50, 50)) for _ in range(rng.randint(3, 60))]
    # A long strip, much wider than it is high, and steps with upright edges.
    rings[40] = [(x * 1000, rng.randrange(3)) for x in range(80)] + [(x * 1000, 10) for x in reversed(range(80))]
    rings[41] = [(x // 2 * 3, (x + 1) // 2 * 2) for x in range(50)] + [(-1, 60)]
    closed = {k: [tuple(map(float, p)) for p in [*r, *r[:1]]] for k, r in rings.items()}
    rows = [*closed.items(), (90, None), (91, [(0.0, 0.0), None, (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)])]
    df = spark.createDataFrame(rows, "id int, ring array<struct<x: double, y: double>>")
    got = {r.id: r.n_crossings for r in self_crossings(df, ["id"]).collect()}
    assert got == {k: n for k, r in closed.items() if (n := crossings(r))} and got[2] == 1
