"""Rings that cross themselves, reported and not repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _edges(rings: DataFrame, key: list[str], ring: str) -> DataFrame:
    """One row per edge: its number, its ends from left to right, and the ring's grid of some edges a cell."""
    low = lambda n: F.array_min(F.transform(ring, lambda p: p[n]))
    high = lambda n: F.array_max(F.transform(ring, lambda p: p[n]))
    sized = rings.where(F.size(ring) > 3).select(
        *key, ring, F.size(ring).alias("_n"), low("x").alias("_x"), low("y").alias("_y"), F.greatest(high("x") - low("x"), high("y") - low("y")).alias("_side")
    )
    ends = F.arrays_zip(F.slice(ring, 1, F.col("_n") - 1).alias("p"), F.slice(ring, 2, F.col("_n") - 1).alias("q"))
    # As many columns as the root of the edges, so that a cell holds few of them.
    cell = F.when(F.col("_side") > 0, F.col("_side") / F.ceil(F.sqrt("_n"))).otherwise(F.lit(1.0))
    rows = sized.select(*key, (F.col("_n") - 1).alias("_n"), "_x", "_y", cell.alias("_w"), F.posexplode(ends).alias("_i", "_e"))
    turned = F.col("_e.p.x") > F.col("_e.q.x")
    a, b = F.when(turned, F.col("_e.q")).otherwise(F.col("_e.p")), F.when(turned, F.col("_e.p")).otherwise(F.col("_e.q"))
    return rows.select(*key, "_n", "_x", "_y", "_w", "_i", a.alias("_a"), b.alias("_b"))


def _in_cells(edges: DataFrame, key: list[str]) -> DataFrame:
    """Each edge under the cells it runs through, column by column."""
    column = lambda x: F.floor((x - F.col("_x")) / F.col("_w"))
    cols = edges.select("*", F.explode(F.sequence(column(F.col("_a.x")), column(F.col("_b.x")))).alias("_cx"))
    left = F.greatest(F.col("_a.x"), F.col("_x") + F.col("_cx") * F.col("_w"))
    right = F.least(F.col("_b.x"), F.col("_x") + (F.col("_cx") + 1) * F.col("_w"))
    wide = F.col("_b.x") - F.col("_a.x")
    at = lambda x: F.col("_a.y") + (F.col("_b.y") - F.col("_a.y")) * (x - F.col("_a.x")) / wide
    # An upright edge keeps its own ends.
    one, two = F.when(wide > 0, at(left)).otherwise(F.col("_a.y")), F.when(wide > 0, at(right)).otherwise(F.col("_b.y"))
    # A little more on both sides, as the heights are rounded.
    row = lambda y, more: F.floor((y - F.col("_y")) / F.col("_w") + more)
    rows = F.sequence(row(F.least(one, two), F.lit(-1e-6)), row(F.greatest(one, two), F.lit(1e-6)))
    return cols.select(*key, "_n", "_i", "_a", "_b", "_cx", F.explode(rows).alias("_cy"))


def self_crossings(rings: DataFrame, key: list[str], ring: str = "ring") -> DataFrame:
    """``key, n_crossings`` for the rings of which two edges cross at an inner point of both.

    ``ring`` is an array of (x, y) that ends where it begins; ``key`` must be unique.  Edges meet
    only in the grid cells they share, so a long ring costs about n^1.5 and is spread
    over tasks by cell.  Edges that touch or lie on each other are no crossing; a NULL ring, one
    with a NULL or without an area has none.
    """
    whole = rings.where(~F.exists(ring, lambda p: p.isNull() | p["x"].isNull() | p["y"].isNull()))
    cells = _in_cells(_edges(whole, key, ring), key)
    names = {k: f"_k{n}" for n, k in enumerate(key)}
    one = cells.select(*[F.col(k).alias(v) for k, v in names.items()], "_cx", "_cy", "_n", *[F.col(f"_{c}").alias(f"{c}1") for c in "iab"])
    two = cells.select(*[F.col(k).alias(v) for k, v in names.items()], "_cx", "_cy", *[F.col(f"_{c}").alias(f"{c}2") for c in "iab"])
    pairs = one.join(two, [*names.values(), "_cx", "_cy"]).where("i2 > i1 + 1 AND NOT (i1 = 0 AND i2 = _n - 1)")
    side = lambda a, b, p: F.signum((b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"]))
    a1, b1, a2, b2 = (F.col(c) for c in ("a1", "b1", "a2", "b2"))
    cross = (side(a1, b1, a2) * side(a1, b1, b2) < 0) & (side(a2, b2, a1) * side(a2, b2, b1) < 0)
    # Two edges that share several cells count once.
    found = pairs.where(cross).select(*names.values(), "i1", "i2").distinct()
    return found.groupBy(*names.values()).agg(F.count(F.lit(1)).alias("n_crossings")).select(*[F.col(v).alias(k) for k, v in names.items()], "n_crossings")
